"""The whole pipeline against brute-force stages, with nulls, ties, repeated ids and empty tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

import corpus_pipeline
from tests.llm.test_other_operators import brute_leaks, brute_measures, encoded, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}


def kept_by_rules(text):
    n, chars, symbols, dup, repeat, lines = brute_measures(text)
    letters = len(re.findall(r"[A-Za-z\x80-\U0010FFFF]", text or ""))
    digits = len(re.findall(r"[0-9]", text or ""))
    return not (
        n < 50 or 100 * repeat > 50 * n or 10 * symbols > 3 * n or (lines > 3 and 100 * dup > 50 * lines)
        or chars < 2 * n or chars > 25 * n or 100 * letters < 50 * chars or 100 * digits > 30 * chars
    )


def without_lines(rows):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    docs = Counter(k for r in rows for k in {key(x) for x in r[1].split("\n")} if k)
    out = []
    for r in rows:
        text = "\n".join(x for x in r[1].split("\n") if docs[key(x)] < 10)
        out.append((r[0], text, *r[2:4], len(text)))
    return out


def fingerprint(text):
    w = words_of(text.translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def one_of_each(rows):
    prints, left, out = [fingerprint(r[1]) for r in rows], set(range(len(rows))), []
    while left:
        group, new = set(), {left.pop()}
        while new:
            group |= new
            new = {j for j in left for i in new if (prints[i] ^ prints[j]).bit_count() <= 4}
            left -= new
        out.append(min((rows[i] for i in group), key=lambda r: (r[0] is None, r[0] or 0)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(20) for _ in range(4)] + [None, ""]
    shared = [prose(6), "Terms of use apply to all pages"]
    texts = [None, "", " \n", "too short", "same words here " * 40, prose(60) + " ##" * 40]
    for i in range(70):
        text = prose(rng.randint(60, 120))
        if i % 3 == 0:
            text = f"{shared[0]}\n{text}\n  {shared[i % 2].upper() if i % 2 else shared[1]} "
        if i % 10 == 5:
            text += f" {items[i % 4]} {prose(5)}"
        texts.append(text)
    texts += [texts[20], texts[20], texts[21] + " indeed", texts[22]]
    ids = [None if i % 17 == 9 else i // 2 if i in (30, 31) else i for i in range(len(texts))]
    rows = [(i, t, "en", rng.choice(["a", "a", "b", None]), len(t or "")) for i, t in zip(ids, texts)]
    return [*rows, rows[40], rows[40], (None, texts[41], "en", "a", 0)], items


def tables(spark, root, rows, items):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus(2)
    sf = tables(spark, tmp_path / "sf", rows, items)
    want = [r for r in rows if kept_by_rules(r[1])]
    steps = [want]
    steps.append(without_lines(steps[-1]))
    steps.append(one_of_each(steps[-1]))
    leaks = {d for d, _ in brute_leaks([r[1] for r in steps[-1]], items, 0.8, 20)}
    steps.append([r for i, r in enumerate(steps[-1]) if i not in leaks])
    assert len({len(s) for s in steps}) == 3 and leaks  # every filter takes some

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted(map(tuple, docs.collect()), key=str) == sorted(steps[k], key=str), name

    # every token of what is left is in one piece, all windows but the last are full
    pieces = corpus_pipeline.run(spark, sf).collect()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
    for r, ids in zip(steps[-1], encoded([r[1] for r in steps[-1]])):
        if sum(x[0] == r[0] for x in steps[-1]) > 1:
            continue  # several documents under this id, or none
        own = sorted(by_doc[r[0]], key=lambda p: p["start"])
        assert [p["start"] for p in own] == [sum(p["length"] for p in own[:i]) for i in range(len(own))]
        assert [p["ids_crc32"] for p in own] == [zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in own]
    total = sum(len(x) for x in encoded([r[1] for r in steps[-1]]))
    assert sum(p["length"] for p in pieces) == total
    sizes = Counter()
    for p in pieces:
        sizes[p["sequence_id"]] += p["length"]
    assert sorted(sizes.values(), reverse=True) == [1024] * (total // 1024) + ([total % 1024] if total % 1024 else [])


def test_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path / "sf", [], [])
    assert corpus_pipeline.run(spark, sf).collect() == []
