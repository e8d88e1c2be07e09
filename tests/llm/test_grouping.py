"""Clustering, prefix trie and Jaccard join against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hourlake.llm import centroid_clustering as cc
from hourlake.llm import jaccard_join as jj
from hourlake.llm import prefix_trie as pt


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


# ---------------------------------------------------------------- centroid clustering


def brute_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    by_hash = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=by_hash)[:k]]
    squared = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for n in range(rounds + 1):
        found = [min((squared(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), f in zip(kept, found) if f[1] == j]
            if own and n < rounds:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    sums = Counter()
    for d, j in found:
        sums[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return ordered((i, j, d, sums[j], sum(sums.values()), sha[j]) for (i, _), (d, j) in zip(kept, found))


def vectors(seed, n, dims=64):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(n // 3)]  # copies
    bad = [(900, None), (901, []), (902, [0.0] * (dims - 1)), (903, [None, *[0.0] * (dims - 1)]), (904, [math.nan, *[0.0] * (dims - 1)]), (905, [math.inf, *[0.0] * (dims - 1)])]
    return [*rows, *bad, (None, [0.5] * dims), (3, [0.25] * dims), (3, [0.25] * dims)]


def embedded(spark, rows):
    ddl = "vec_id long, embedding array<double>, cluster string, distance long, x int"
    return spark.createDataFrame([(i, e, "c", 1, 2) for i, e in rows], ddl).repartition(3)


def test_clusters_equal_brute_force(spark, monkeypatch):
    rows = vectors(1, 60)
    want = brute_clusters(rows)
    assert ordered(cc.clustered(embedded(spark, rows)).collect()) == want
    monkeypatch.setattr(cc, "PAGE", 7)
    assert ordered(cc.clustered(embedded(spark, rows)).collect()) == want


def test_clusters_of_large_components(spark):
    rows = [(i, [float(i * 150_000), *[0.5] * 63]) for i in range(12)]
    assert ordered(cc.clustered(embedded(spark, rows), k=3).collect()) == brute_clusters(rows, k=3)
    top = (1 << 63) - 1
    far = [(0, [1e30, *[0.0] * 63]), (1, [-1e30, *[0.0] * 63]), (2, [0.0] * 64)]
    got = {r.vec_id: r for r in cc.clustered(embedded(spark, far), k=1, rounds=1).collect()}
    assert got[0].distance == got[1].distance == got[0].inertia == top and got[2].distance < top


def test_few_or_no_vectors(spark):
    few = [(1, [0.1] * 64), (2, [0.2] * 64)]
    assert ordered(cc.clustered(embedded(spark, few)).collect()) == brute_clusters(few)
    empty = cc.clustered(embedded(spark, few).limit(0))
    assert empty.collect() == [] and [f.dataType.simpleString() for f in empty.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


@pytest.mark.parametrize("copies", [1, 40])
def test_pages_are_lossless(copies):
    rng = np.random.default_rng(2)
    v = np.repeat(rng.integers(-(1 << 40), 1 << 40, (50, 64)), copies, axis=0)
    width, dictionaries, codes = cc.encode(v)
    assert np.array_equal(np.concatenate([d[c] for d, c in zip(dictionaries, codes.T)], axis=1), v)
    assert width == 64 if copies > 1 else True


# ---------------------------------------------------------------- prefix trie


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, r, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), x))
    rebuilt = {}
    for c in turns:
        turns[c].sort()
    for c, own in turns.items():
        h, first = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        rebuilt[c] = tuple((t[2], t[4]) for t in turns.get(first, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    ends = {k: ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)) for k, m in members.items()}
    return ordered(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items()
    )


def talked(spark, rows):
    ddl = "conv_id long, turn long, role string, text string, depth string, pos int, block string"
    return spark.createDataFrame([(*r, "d", 1, "b") for r in rows], ddl).repartition(3)


def chats(seed, n):
    rng = random.Random(seed)
    lines = [list("abcdefghijklmnop"), list("abxdefghqrst"), list("aéxd"), ["same"] * 9]
    rows = []
    for c in range(n):
        line = rng.choice([*lines, [f"only {c}"] * rng.randint(1, 3)])
        for t in range(rng.randint(1, len(line))):
            role = rng.choice(["user", "user", "user", "assistant", None]) if rng.random() < 0.1 else "user"
            rows.append((c, t if rng.random() < 0.97 else None, role, line[t] if rng.random() < 0.97 else None))
    long_one = [(n, t, "user", f"{t % 7}") for t in range(150)]
    copies = [(n + 1 + c, t, "user", x) for c in range(60) for t, x in enumerate("abcdefghi")]
    gone = [r for r in rows if r[0] != 100]  # a family without its first conversation
    return [*gone, *long_one, *copies, (None, 1, "user", "nobody's"), (-5, 0, "user", "a"), (-205, 0, None, None), gone[0], gone[0]]


def test_trie_equals_brute_force(spark, monkeypatch):
    rows = chats(1, 230)
    want = brute_trie(rows)
    assert ordered(pt.prefix_trie(talked(spark, rows)).collect()) == want
    monkeypatch.setattr(pt, "CHUNK", 3)
    monkeypatch.setattr(pt, "PIECE", 8)
    assert ordered(pt.prefix_trie(talked(spark, rows), block=3).collect()) == want


def test_small_tries(spark):
    assert pt.prefix_trie(talked(spark, [(1, 1, "a", "b")]).limit(0)).collect() == []
    for rows in ([(7, 1, "u", "x")], [(150, 1, "u", "x")], [(None, 1, "u", "x")], [(1, 1, "u", ""), (2, 1, None, None)]):
        assert ordered(pt.prefix_trie(talked(spark, rows)).collect()) == brute_trie(rows)


# ---------------------------------------------------------------- Jaccard join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_jaccard(rows, size=3, num=90, den=100):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for (i, _), r in zip(rows, map(find, range(len(sets)))):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return ordered((i, len(s), least.get(find(x)) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets)))


def worded(spark, rows):
    ddl = "doc_id long, text string, token string, cls int, n string, component_id string, g long"
    return spark.createDataFrame([(*r, "t", 1, "n", "c", 2) for r in rows], ddl).repartition(3)


def families(seed):
    """Families of near copies with few to many changes, around the threshold; hubs that join variants; shared passages."""
    rng = random.Random(seed)
    out, at = [], 100
    passage = " ".join(f"p{k}" for k in range(40))
    for copies, length, edits in [(40, 100, 1), (40, 100, 2), (60, 60, 1), (40, 200, 4), (25, 12, 1), (8, 2000, 30)]:
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(length)] = f"x{rng.randrange(40)}"
            out.append((at, " ".join(text)))
            at += 1
    out += [(at + k, f"{passage} y{k} y{k + 1} y{k % 3}") for k in range(40)]
    rng.shuffle(out)
    return out


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a\tB"), (8, "a b c"), (None, "q w e r t y"), (None, "q w e r t y"), (9, "q w e r t y"), (9, "other text here now"), (9, "other text here now"), (None, "alone with no id"), (10, "é É"), (11, "é É")]


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(jj, "GROUP", 5)
        monkeypatch.setattr(jj, "TOKENS", 3000)
        monkeypatch.setattr(jj, "QUERIES", 7)
        monkeypatch.setattr(jj, "SLICE", 64)
    rows = [*EDGES, *families(3)]
    rows += [(800 + k, rows[-1][1]) for k in range(30)]  # copies
    assert ordered(jj.jaccard_components(worded(spark, rows)).collect()) == brute_jaccard(rows)


def test_jaccard_of_another_threshold_and_of_nothing(spark):
    rows = [*EDGES, *families(4)[::3]]
    assert ordered(jj.jaccard_components(worded(spark, rows), 2, 70, 100).collect()) == brute_jaccard(rows, 2, 70)
    assert jj.jaccard_components(worded(spark, rows).limit(0)).collect() == []


def test_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = jj.overlaps(sets)
    assert all(got[i, j] == want[i][j] for i in range(20) for j in range(20) if i != j)
