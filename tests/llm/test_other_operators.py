"""The other operators against brute force, exact round trips or held-out accuracy, and their edge cases."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourlake.llm import components, decontaminate, maxent_lm, packing, quality_rules, queries, simhash, toxicity, url_filter

DDL = "doc_id long, text string, lang string, source string, n_chars long, component long, score double, fp string"


def frame(spark, texts, ids=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, 0, 1, 0.5, "x") for i, t, s in zip(ids, texts, sources)], DDL).repartition(3)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---------------------------------------------------------------- quality rules


def brute_measures(text):
    text = text or ""
    w = words_of(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(lines)


def test_quality_measures_equal_brute_force(spark):
    rng = random.Random(1)
    pool = ["the", "a", "é", "#x", "|", "\n", "\n\n", "\t", "𝄞", "end.\n", "same line\n"]
    texts = [None, "", "\n", "x", "a a a a", "line\nline\nline", " line\nline", *["".join(rng.choice(pool) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 80))) for _ in range(60)]]
    df = quality_rules.ledger(frame(spark, texts))
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()} == {i: brute_measures(t) for i, t in enumerate(texts)}


def test_policies_and_ablation(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{i}x" for i in range(80))
    symbols = " ".join(f"word{i}x ##" for i in range(60))
    texts = [good, None, "too short", "same words here " * 40, symbols, "too short ## ## ##"]
    entries = quality_rules.apply_policy(quality_rules.ledger(frame(spark, texts)))
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in entries.collect()}
    assert kept == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False), 4: (False, False), 5: (True, False)}
    rules = {r["rule"]: (r["failing"], r["only_this"]) for r in quality_rules.ablation(entries).collect()}
    assert rules["few_words"] == (3, 2) and rules["repeated_windows"] == (1, 1) and rules["symbols"] == (2, 1)
    out = quality_rules.passing_documents(frame(spark, texts))
    assert out.columns == frame(spark, []).columns and [tuple(r) for r in out.collect()] == [(0, good, "en", "s", 0, 1, 0.5, "x")]
    assert quality_rules.passing_documents(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words_of((text or "").translate(lower))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps: dict, distance: int) -> dict:
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_simhash_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(300)}" + rng.choice(["", "É", "X"])
    texts = [None, "", " \t", "one", "One  two\tTHREE"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 400))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_components(fps, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(frame(spark, texts)).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("distance, bucket", [(4, 4096), (4, 3), (0, 4096), (2, 1), (7, 2)])
def test_links_connect_all_that_is_near(spark, distance, bucket):
    rng = random.Random(distance)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 9)):
            values.add(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    values |= {0, 1, 3, 7, 15, 31, (1 << 64) - 1}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    links = [(r["x"] % (1 << 64), r["y"] % (1 << 64)) for r in simhash.links_within(fps, distance, bucket).collect()]
    assert all(bin(a ^ b).count("1") <= distance and a != b for a, b in links)
    found = spark.createDataFrame([(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b) for a, b in links], "a long, b long")
    root = {r["node"] % (1 << 64): r["component"] for r in components.components(found).collect()}
    want = brute_components({v: v for v in values}, distance)
    groups, own = defaultdict(set), defaultdict(set)
    for v in values:
        groups[want[v]].add(v)
        own[root.get(v, ("alone", v))].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_thresholds_cover_the_distance():
    for distance in range(8):
        for widths in ([32, 32], [22, 21, 21], [13, 13, 13, 13, 12], [64]):
            cost, t = simhash.allocate(1000, widths, [float(10 ** (k + 3)) for k in range(len(widths))], distance)
            assert sum(x + 1 for x in t) == distance + 1 and min(t) >= -1
    # a partition whose values are all equal is not probed if others can do it
    assert simhash.allocate(10**6, [32, 32], [1e12, 1e6], 1)[1] == [-1, 1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    docs = frame(spark, [b, a, a, None, "", b, b], ids=[9, 4, 2, 7, 6, 9, None])
    out = simhash.first_of_each(docs)
    assert out.schema == docs.schema
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(2, a), (6, ""), (9, b)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(docs).collect()}
    assert got == {9: 9, 4: 2, 2: 2, 7: 6, 6: 6, None: 9}
    assert simhash.simhash_components(frame(spark, [])).count() == 0


def test_unrelated_documents_with_null_or_repeated_ids_all_stay(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(50))
    docs = frame(spark, [*map(text, "abcdea"), text("f"), text("f")], ids=[None, None, None, 7, 7, 8, None, None])
    kept = sorted((r["doc_id"] or -1, r["text"][0]) for r in simhash.first_of_each(docs).collect())
    assert kept == [(-1, "b"), (-1, "c"), (-1, "f"), (7, "d"), (7, "e"), (8, "a")]
    named = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    assert named == {(None, None), (None, 8), (7, 7), (8, 8)}


def test_columns_may_have_any_name(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    names = "_key long, _copy string, _nd_key long, _nd_copy long, _doc string, root long, least long, _id long, _row long, `k.x` long"
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3, "d", 4, 5, 6, 7, 8) for i, t in [(1, a), (2, a), (3, b)]], f"doc_id long, text string, {names}")
    bench = spark.createDataFrame([(1, b)], "item_id long, text string")
    for out, ids in ((simhash.first_of_each(docs), [1, 3]), (decontaminate.clean_documents(docs, bench), [1, 2])):
        assert out.schema == docs.schema
        assert sorted(out.collect()) == sorted(r for r in docs.collect() if r.doc_id in ids)


# ---------------------------------------------------------------- decontamination


def brute_leaks(texts, items, threshold, radius):
    def shingles(w, size):
        return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]

    out = set()
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for d, t in enumerate(texts):
        w = cut(t)
        for k, item in enumerate(items):
            q = cut(item)
            n = min(len(q), len(w))
            if not n:
                continue
            want = Counter(shingles(q, min(5, len(q))))
            for s in range(len(w) - n + 1):
                have = Counter(shingles(w[s : s + n], min(5, n)))
                if (have & want).total() >= threshold * (have | want).total():
                    out.add((d, k))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(400)}"
    items = [" ".join(word() for _ in range(n)) for n in (3, 12, 30, 60, 60)] + ["a b a b a b a b a b", None, "..."]
    items[4] = items[3]
    texts = [None, "", "w1"]
    for _ in range(60):
        own = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            leak = (rng.choice(items[:6]) or "").split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if leak:
                    k = rng.randrange(len(leak))
                    leak[k : k + 1] = rng.choice([[word()], [], [leak[k], word()]])
            own[len(own) // 2 : len(own) // 2] = leak
        texts.append(rng.choice([" ", ", ", "\n"]).join(own).upper() if rng.random() < 0.3 else " ".join(own))
    docs, bench = frame(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(docs, bench, 0.8, radius=24).collect()}
    assert found == brute_leaks(texts, items, 0.8, 24) and len(found) > 10
    clean = decontaminate.clean_documents(docs, bench, 0.8, radius=24)
    assert clean.schema == docs.schema and {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in found}


def test_simhash_of_windows_is_the_majority(spark):
    rng = random.Random(8)
    rows = [(k, [rng.getrandbits(64) - (1 << 63) for _ in range(k)]) for k in (1, 2, 5, 40, 41, 300, 9000, 40_000)]
    df = decontaminate.with_simhash(spark.createDataFrame(rows, "k int, shingles array<long>"), ["k"])
    for k, fp in [tuple(r) for r in df.collect()]:
        hs = dict(rows)[k]
        assert fp % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum((h % (1 << 64)) >> b & 1 for h in hs) > k)


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0
    assert decontaminate.contamination(frame(spark, ["a b c d e f g"]), bench.limit(0)).count() == 0
    found = decontaminate.contamination(frame(spark, ["x a b c d e f g y"] * 3, ids=[None, 3, 3]), bench).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["similarity"], r["hamming"]) for r in found) == [(0, 1, 1.0, 0), (3, 1, 1.0, 0)]


def test_only_documents_with_windows_are_dealt_out(spark, monkeypatch, tmp_path):
    """Where the keys of documents with windows are too many to be broadcast, the other documents still stay where they are."""
    item = " ".join(f"q{i}" for i in range(20))
    texts = [" ".join(f"w{(i * 7 + k) % 90}" for k in range(40)) + (f" {item}" if i % 100 == 5 else "") for i in range(500)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents")
    docs, bench = spark.read.parquet(f"{tmp_path}/documents"), spark.createDataFrame([(1, item)], "item_id long, text string")
    write, dealt = decontaminate.written, []

    def noted(df, label):
        if label == "window-words":
            df.collect()
            plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
            dealt.extend(float(n) for n in re.findall(r"ShuffleQueryStage.*rowCount=([\d.E+]+)", plan))
        return write(df, label)

    monkeypatch.setattr(decontaminate, "written", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontaminate.contamination(docs, bench).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["doc_id"] for r in found) == [5, 105, 205, 305, 405]
    assert dealt and max(dealt) < 50


def test_documents_with_large_row_groups_are_read_in_pieces(spark, monkeypatch, tmp_path):
    """Else each task holds a whole column of a row group outside the heap too."""
    frame(spark, ["a b c d e f g", "x"]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held, contamination = [], decontaminate.contamination
    monkeypatch.setattr(decontaminate, "contamination", lambda docs, bench: held.append(docs) or contamination(docs, bench))
    assert [r["doc_id"] for r in queries.op4_decontaminate(spark, str(tmp_path)).collect()] == [0]
    options = held[0]._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().options()
    assert options.get("parquet.hadoop.vectored.io.enabled").get() == "false"


# ---------------------------------------------------------------- toxicity


def test_folding():
    assert toxicity.fold("An 1D10T, іdіоt i\u200bdiot and 1984!") == ["an", "idiot", "idiot", "idiot", "and"]
    assert toxicity.fold("Événement numéro 3") == ["événement", "numéro"]
    assert toxicity.fold("") == []


def test_lexicon_matching_and_exceptions():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " idiot": 5.0, " idiotic ": 2.0}, frozenset({" trash can "}), (1.0, 0.0, -2.0))
    m = lexicon.matcher()
    assert [(e, w) for _, e, w in m.matches("you idiotic trash".split())] == [(" idiot", 5.0), (" trash ", 3.0)]
    assert m.matches("the trash can is full".split()) == []
    assert m.score([]) == m.score(["fine"]) < 0.3 < m.score(["idiot"])
    assert toxicity.Lexicon({}, frozenset(), (0.0, 0.0, 0.0)).matcher().score(["x"]) == 0.5


def brute_matches(lexicon, words):
    """Heaviest entry that begins at each word, unless an exception phrase holds all of it."""
    text = " " + " ".join(words) + " "
    spans = lambda phrase: [(m.start(), m.start() + len(phrase)) for m in re.finditer(f"(?={re.escape(phrase)})", text)]
    spared = [x for e in lexicon.exceptions for x in spans(e)]
    best = {}
    for entry, weight in lexicon.entries.items():
        for a, b in spans(entry):
            if not any(x <= a and b <= y for x, y in spared) and weight > best.get(a, ("", 0.0))[1]:
                best[a] = (entry, weight)
    return [(text[:a].count(" "), *best[a]) for a in sorted(best)]


def test_matching_equals_brute_force():
    rng = random.Random(9)
    pool = ["trash", "trashy", "tra", "can", "idiot", "idiotic", "fine", "id"]
    for _ in range(300):
        entries = {f" {w}{rng.choice(['', ' '])}": rng.random() for w in rng.sample(pool, 4)}
        exceptions = frozenset(f" {rng.choice(pool)} {rng.choice(pool)} " for _ in range(rng.randint(0, 4)))
        lexicon = toxicity.Lexicon(entries, exceptions, (1.0, 0.0, -2.0))
        words = [rng.choice(pool) for _ in range(rng.randint(0, 25))]
        assert lexicon.matcher().matches(words) == brute_matches(lexicon, words)


def test_very_long_texts_take_linear_time():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " idiot": 5.0}, frozenset({" trash can ", " idiot proof "}), (1.0, 0.0, -2.0))
    m, words = lexicon.matcher(), ["trash", "can", "idiot", "proof", "idiot", "trash"] * 50_000
    start = time.perf_counter()
    assert len(m.matches(words)) == 100_000
    assert time.perf_counter() - start < 5


def test_a_repeated_labelled_id_is_one_example(spark, monkeypatch):
    docs = frame(spark, ["grumbo"] * 50 + ["fine"] * 3, ids=[1] * 50 + [3, 4, 5])
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (3, 0, 0), (4, 0, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    seen, plain = [], toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df, label: seen.append(df.count()) or plain(df, label))
    toxicity.learn(docs, labels, F.lit(True))
    assert seen == [4]


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(6)
    texts, marks = [], []
    for i in range(600):
        w = [f"w{rng.randrange(500)}" for _ in range(rng.randint(20, 80))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            w[rng.randrange(len(w))] = rng.choice(["grumbo", "Grumb0", "flarnish", "snarkel"])
        if i % 7 == 3:
            w[5:5] = ["snarkel", "soup"]  # harmless
        texts.append(" ".join(w))
        marks.append((i, 0, int(bad)))
    texts += [None, ""]
    labels = spark.createDataFrame(marks + [(None, 0, 1), (10_000, 0, None)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, texts), labels).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in range(600) if rows[i]["held_out"]} == set(held)
    right = sum((rows[i]["predicted"] == 1) == (i % 5 == 0) for i in held)
    assert right / len(held) > 0.97
    assert rows[600]["predicted"] == rows[601]["predicted"] == 0 and 0 <= rows[600]["score"] < 0.3


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(frame(spark, ["a", None], ids=[1, None]), labels).collect()
    assert [r["score"] for r in out] == [0.5, 0.5] and not any(r["held_out"] is None for r in out)
    assert toxicity.toxicity(frame(spark, []), labels).count() == 0


# ---------------------------------------------------------------- packing


def encoded(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary_path())
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [0], dtype="<u4") for x in texts]


def check_packing(pieces, texts, length):
    """Round trip: every token once, in order; sequences without gaps; all but the last full."""
    ids = encoded(texts)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(range(len(texts)))
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[d])
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[d][p["start"] : at].tobytes())
        assert at == len(ids[d])
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
    total = sum(map(len, ids))
    assert sorted(by_seq) == list(range(-(-total // length)))
    assert sum(sum(p["length"] for p in own) < length for own in by_seq.values()) <= 1
    return by_seq


@pytest.mark.parametrize("length, chunk", [(64, 1 << 20), (16, 200), (1024, 50)])
def test_packing_round_trip_and_mixture(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)
    rng = random.Random(length)
    texts = [None, "", "<|endoftext|> x", "смесь 語 é", *[" ".join(rng.choice(["alpha", "beta", "Été", "x9", "\n"]) for _ in range(rng.randint(0, 120))) for _ in range(80)]]
    sources = [rng.choice(["big", "big", "mid", None, f"tiny{k}"]) for k in range(len(texts))]
    pieces = packing.pack(frame(spark, texts, sources=sources), queries.vocabulary_path(), length).collect()
    by_seq = check_packing(pieces, texts, length)
    tokens = {i: len(x) for i, x in enumerate(encoded(texts))}
    total = sum(tokens.values())
    share = sum(n for i, n in tokens.items() if sources[i] == "big") / total
    for own in by_seq.values():
        n = sum(p["length"] for p in own)
        big = sum(p["length"] for p in own if sources[p["doc_id"]] == "big")
        assert abs(big - share * n) < 5


def test_packing_towards_a_target(spark):
    texts = ["alpha beta " * 50] * 40
    sources = ["a", "b"] * 20
    pieces = packing.pack(frame(spark, texts, sources=sources), queries.vocabulary_path(), 100, target={"a": 0.75, "b": 0.25}).collect()
    by_seq = check_packing(pieces, texts, 100)
    for k in range(10):  # until a is used up
        assert abs(sum(p["length"] for p in by_seq[k] if sources[p["doc_id"]] == "a") - 75) <= 1


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_many_small_sources_are_mixed(spark, monkeypatch, chunk):
    """Each of 70 sources, none with 1/64 of the tokens, has its share in every window, to within a run at either end."""
    monkeypatch.setattr(packing, "CHUNK", chunk)
    monkeypatch.setattr(packing, "SPAN", 1500, raising=False)
    texts = [" ".join(["alpha", "beta"] * (20 + i % 3)) for i in range(350)]
    sources = [f"s{i // 5}" for i in range(350)]
    length = 512  # runs of 8
    by_seq = check_packing(packing.pack(frame(spark, texts, sources=sources), queries.vocabulary_path(), length).collect(), texts, length)
    sizes = [len(x) for x in encoded(texts)]
    for s in set(sources):
        share = sum(n for n, x in zip(sizes, sources) if x == s) / sum(sizes)
        had = 0
        for k in range(len(by_seq)):
            had += sum(p["length"] for p in by_seq[k] if sources[p["doc_id"]] == s)
            assert abs(had - share * min((k + 1) * length, sum(sizes))) <= 10


def test_a_target_for_many_sources(spark):
    """Weights for 80 sources are held, and an exhausted one's share goes to all others in their proportions."""
    texts = ["alpha beta " * 50] * 200
    sources = [*["big"] * 120, *[f"s{k}" for k in range(79)], "s0"]
    target = {"big": 0.5, "s0": 0.11, **{f"s{k}": 0.005 for k in range(1, 79)}}
    pieces = packing.pack(frame(spark, texts, sources=sources), queries.vocabulary_path(), 256, target=target).collect()
    by_seq = check_packing(pieces, texts, 256)
    got = lambda s, k: sum(p["length"] for j in range(k) for p in by_seq[j] if sources[p["doc_id"]] == s)
    n = len(encoded(texts[:1])[0])
    early = int(2 * n / 0.11 // 256)  # s0 is used up
    assert abs(got("big", early) - early * 128) <= 2 and abs(got("s0", early) - 0.11 * early * 256) <= 2
    assert all(abs(got(f"s{k}", early) - 0.005 * early * 256) <= 6 for k in range(1, 79))
    late = early + 10
    big = got("big", late)
    assert big > late * 128 + 60
    assert all(abs(got(f"s{k}", late) - big / 100) <= 6 for k in range(1, 79))


def test_emitted_is_monotone_and_exact():
    tokens = np.array([1000, 7, 350, 1])
    got = packing.emitted(np.arange(0, 1400), tokens.astype(float), tokens)
    assert (got.sum(axis=1) == np.minimum(np.arange(0, 1400), 1358)).all()
    assert (np.diff(got, axis=0) >= 0).all() and got[-1].tolist() == tokens.tolist()


def test_packing_nothing(spark):
    out = packing.pack(frame(spark, []), queries.vocabulary_path())
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "start", "length"]


# ---------------------------------------------------------------- URLs


URLS = [
    (None, "", "", None, None), ("no scheme", "", "", None, None), ("http://A.Org/x", "a.org", "/x", "org/", "allow"),
    ("http://a.org", "a.org", "", None, None), ("https://www.example.org/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/1#t", "example.org", "/en/1", "example.org/en/1", "block"), ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("ftp://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("http://x.com/de/?q=/fr/", "x.com", "/de/", "com/de/", "block"), ("http://xcom/de/", "xcom", "/de/", None, None),
    ("http://É.com/fr/a://b", "É.com", "/fr/a://b", "com/fr/", "allow"), ("://x.org/", "x.org", "/", "org/", "allow"), ("http://?x", "", "", None, None),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "h", "c") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in url_filter.judged(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_trees_learn_labelled_urls(spark):
    rng = random.Random(3)
    rows = []
    for i in range(800):
        bad = i % 2
        name = "".join(rng.choice("0123456789abcxyz" if bad else "etaoin") for _ in range(25 if bad else 8))
        rows.append((i, f"http://{name}.example.com/{'de' if bad else 'fr'}/{name}"))
    rows += [(10_000 + i, u.replace(".com/", ".net/")) for i, u in rows]
    out = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()
    right = sum((r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in out)
    assert len(out) == 800 and right > 760


def test_suffix_statistics_cover_all_labelled_rows(spark, monkeypatch):
    """However small the trees' sample is."""
    rng = random.Random(4)
    urls = [f"http://h{k}.s{rng.randint(0, 30)}.com/{rng.choice(['fr', 'de', 'de'])}/{k % 50}" for k in range(600)] + ["http://x.hot.com/de/1"] * 300
    seen, plain = [], url_filter.with_suffix_statistics
    monkeypatch.setattr(url_filter, "with_suffix_statistics", lambda rows, stats: seen.append(stats) or plain(rows, stats))
    out = url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), sample=20)
    assert out.count() == len(urls)
    rows, blocked = Counter(), Counter()
    for u in urls:
        suffix = ".".join(u.split("/")[2].split(".")[-2:])
        rows[suffix] += 1
        blocked[suffix] += "/de/" in u
    for stats in seen:
        got = {r["suffix"]: (r["suffix_share"], r["suffix_blocked"]) for r in stats.collect()}
        assert set(got) == set(rows)
        for s, n in rows.items():
            assert got[s] == pytest.approx((n / len(urls), (blocked[s] + 1) / (n + 2)))


def test_a_repeated_url_does_not_fill_the_sample(spark):
    signed = lambda u: (xxhash.xxh64_intdigest(u, 42) + (1 << 63)) % (1 << 64)
    urls = sorted((f"http://h{k}.com/{('fr', 'de')[k % 2]}/{'9' * (k % 2 * 20)}{k}" for k in range(400)), key=signed)
    urls = [urls[0]] * 500 + urls[1:] + ["http://h.net/", "http://h.net/" + "9" * 24]
    out = url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), sample=100).where("rule is null").collect()
    good, bad = (r["probability"] for r in sorted(out, key=lambda r: r["page_id"]))
    assert 1e-6 < good < 0.5 < bad < 1 - 1e-6


# ---------------------------------------------------------------- language model


def test_lm_counts_and_base_score(spark, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "Only Here", *[" ".join(rng.choice(["the", "The", "a", "é", "É", *[f"x{k}" for k in range(200)]]) for _ in range(rng.randint(0, 60))) for _ in range(120)]]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[*words_of((t or "").translate(lower)), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = c.total(), len(c)
    for head, each in ((5, 1 << 22), (5, 9), (1 << 18, 1 << 22)):
        monkeypatch.setattr(maxent_lm, "TOKENS_PER_TASK", each)
        for r in maxent_lm.lm_scores(frame(spark, texts), head=head).collect():
            own = tokens[r["doc_id"]]
            base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(c[w] > 0 for w in own), n)
            assert r["base_score"] == pytest.approx(base, abs=1e-9) and r["score"] < 0


def test_lm_beats_word_frequencies_on_held_out_texts(spark):
    rng = random.Random(6)
    tongues = [[f"{p}{k}{e}" for k in range(150)] for p, e in (("a", "th"), ("b", "ung"), ("c", "os"))]
    texts = [" ".join(rng.choice(tongues[i % 3]) for _ in range(120)) for i in range(300)]
    rows = [r for r in maxent_lm.lm_scores(frame(spark, texts)).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.2 * sum(r["n_tokens"] for r in rows)


def test_lm_probabilities_add_up():
    """The classes' probabilities add up to one, and so do the words' within a class with its unknown words."""
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(maxent_lm.KINDS, maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    data = np.frombuffer(b"a b c a b unknown words here", np.uint8)
    tokens, begins = maxent_lm.tokens_of(data, np.array([0, 11, len(data)]))
    f = maxent_lm.features_of(tokens, maxent_lm.classes_of(tokens, np.sort(tokens[:2])), begins)
    assert np.exp(maxent_lm.log_softmax(weights, f)).sum(axis=1) == pytest.approx(np.ones(len(tokens)), abs=1e-5)
    assert len(tokens) == 10 and begins.tolist() == [0, 6, 10] or tokens[begins[1:] - 1].tolist() == [0, 0]


def small_tree(rng, words=400, head=150):
    """Words of one class (few of them frequent), and their tree."""
    text = " ".join(f"w{k}zz" for k in range(words)).encode()
    h = np.unique(maxent_lm.tokens_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0])
    h = h[h != 0]
    counts = rng.integers(1, 1000, len(h)) ** 2
    known = np.sort(rng.permutation(len(h))[:head])
    rare = np.setdiff1d(np.arange(len(h)), known)
    cls = (h & np.uint64(31)).astype(int)
    mass, many = np.ones(maxent_lm.CLASSES), np.zeros(maxent_lm.CLASSES)
    np.add.at(mass, cls[rare], counts[rare] + 1)
    np.add.at(many, cls[rare], 1)
    tree = maxent_lm.Tree.of(h[known], counts[known], h[:0], mass, many, words)
    return h, counts, cls, rare, mass, tree


def test_lm_words_within_a_class_come_from_a_softmax():
    """Whatever stands before: a class's words and what is unknown add up to one; without weights they have their shares."""
    rng = np.random.default_rng(2)
    h, counts, cls, rare, mass, tree = small_tree(rng)
    assert len(set(cls)) == 1
    zero = np.zeros((maxent_lm.KINDS, tree.rows, maxent_lm.FAN), np.float32)
    weights = rng.normal(size=zero.shape).astype(np.float32)
    at, known = tree.find(h)
    assert known.sum() == 150 and not known[rare].any()
    given = []
    for seed in (3, 4, 5):
        hashes = [np.full(len(h), np.uint64(x)) for x in np.random.default_rng(seed).integers(1, 1 << 62, maxent_lm.KINDS)]
        token, f, start, chosen = tree.choices(h, cls, hashes, at, known)
        logs = lambda w: np.bincount(token, weights=maxent_lm.log_chosen(w, f, chosen, start), minlength=len(h))  # noqa: E731,B023
        p = np.exp(logs(weights))
        # rare words of one leaf share its path
        leaf = maxent_lm.leaves_of(h[rare], cls[rare], tree.depths)
        _, first = np.unique(leaf, return_index=True)
        digits = maxent_lm.FAN ** int(tree.depths[cls[0]])
        assert len(rare) <= digits < maxent_lm.FAN * len(rare)
        whole = p[known].sum() + p[rare][first].sum()
        assert 0 < whole <= 1 + 1e-4
        everything = rare_total(tree, cls[0], hashes, weights)
        assert p[known].sum() + everything == pytest.approx(1, abs=1e-4)
        given.append(p)
        total = (counts[known] + 1).sum() + mass[cls[0]]
        assert np.exp(logs(zero))[known] == pytest.approx((counts[known] + 1) / total, rel=1e-4)
    assert abs(given[0] / given[1] - 1).max() > 0.5  # the words before make a difference


def rare_total(tree, c, hashes, weights):
    """Probability of all leaves of the rare words of a class: of the path down to them, found by taking the known words away."""
    place = len(tree.head) + c
    j = np.arange(tree.first[place], tree.first[place + 1])
    unseen = np.array([np.uint64(c)])
    _, f, start, chosen = tree.choices(unseen, np.array([c]), [x[:1] for x in hashes], np.zeros(1, int), np.array([False]))
    return float(np.exp(maxent_lm.log_chosen(weights, f, chosen, start)[: len(j)].sum()))


@pytest.mark.parametrize(("head", "gain"), [(maxent_lm.HEAD, 0.8), (40, 0.5)])
def test_lm_learns_which_word_of_a_class_follows(spark, head, gain):
    """All words end alike, so nothing but the choice within classes can tell which follows which."""
    rng = random.Random(11)
    names = [f"{k:03d}zz" for k in range(200)]
    follows = {w: names[(7 * i + 3) % 200] for i, w in enumerate(names)}
    texts = []
    for _ in range(400):
        w = rng.choice(names)
        text = [w]
        for _ in range(60):
            w = follows[w]
            text.append(w)
        texts.append(" ".join(text))
    rows = [r for r in maxent_lm.lm_scores(frame(spark, texts), head=head).collect() if r["held_out"]]
    # word frequencies alone give each of 200 words about 2.3 (a class of its own saves little)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + gain * sum(r["n_tokens"] for r in rows)


def test_lm_weights_are_sent_by_tokens_not_by_partitions(spark, monkeypatch):
    """Documents in many partitions: few tasks send weights, and these have learned from every training token."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(29)) for _ in range(400)]
    average, sent = maxent_lm._average, []

    def noted(slots):
        sent.append(slots.where("slot = 0").select("part", "weight").collect())
        return average(slots)

    monkeypatch.setattr(maxent_lm, "_average", noted)
    for each in (1 << 19, 1000):
        monkeypatch.setattr(maxent_lm, "TOKENS_PER_TRAINER", each, raising=False)
        sent.clear()
        rows = maxent_lm.lm_scores(frame(spark, texts).repartition(40)).collect()
        total = rows[0]["train_tokens"]
        most = -(-total // (maxent_lm.ROUNDS * each))
        assert len(rows) == 400 and len(sent) == maxent_lm.ROUNDS
        assert all(1 <= len(tasks) <= most < 40 for tasks in sent)
        assert all(len({r["part"] for r in tasks}) <= math.ceil(math.sqrt(most)) for tasks in sent)
        assert sum(r["weight"] for tasks in sent for r in tasks) == total


def test_lm_of_nothing(spark):
    assert maxent_lm.lm_scores(frame(spark, [])).count() == 0
    alone = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = maxent_lm.lm_scores(frame(spark, ["all held out"], ids=[alone])).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 4, 0, 0, 0.0)
