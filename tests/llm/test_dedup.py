"""Suffix-array, substring and line dedup against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from hourlake.llm import common, line_dedup, repeats, substring_dedup, suffix_array_dedup
from hourlake.llm.rolling import sliding_min, words

DDL = "doc_id long, text string, lang string, source string, n_chars long, n_lines long, _row string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, 7, "x") for i, t in zip(ids, texts)], DDL).repartition(3)


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def corpus(seed: int, n: int, vocabulary: int = 40) -> list[str | None]:
    """Random texts with copies, shared passages, odd spaces, periodic text, empties and nulls."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) if rng.random() < 0.5 else f"w{rng.randrange(vocabulary)}"
    passages = [" ".join(word() for _ in range(rng.randint(4, 30))) for _ in range(5)]
    out: list[str | None] = [None, "", " \n\t ", "a", "ab " * 60, "z" * 90, "é" * 30]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 12))))
        out.append(rng.choice([" ", "\n", "  ", "\t"]).join(parts))
        if rng.random() < 0.2:
            out.append(rng.choice(out))
    return out


def brute_bytes(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for t in raw:
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] = seen.get(t[i : i + size], 0) + 1
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(kept), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def brute_words(texts, ids, size):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    low = lambda i: -(1 << 63) if i is None else i
    first: dict[tuple, int] = {}
    for i, w in zip(ids, split):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, low(i)), low(i))
    out = []
    for i, w in zip(ids, split):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < low(i):
                gone[k : k + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return out


def got(df, *cols):
    return sorted((tuple(r) for r in df.select("doc_id", *cols).collect()), key=repr)


@pytest.mark.parametrize("size, hot, shard", [(20, 512, 1 << 20), (12, 2, 1 << 20), (12, 4, 1 << 20), (12, 512, 300), (9, 10_000, 60)])
def test_suffix_arrays_equal_brute_force(spark, size, hot, shard):
    texts = corpus(1, 60)
    df = suffix_array_dedup.suffix_array_dedup(frame(spark, texts), size=size, hot=hot, shard=shard)
    want = sorted(((i, *b) for i, b in enumerate(brute_bytes(texts, size))), key=repr)
    assert got(df, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    row = df.where("doc_id = 5").first()  # one byte, ninety times
    assert row["text"] == b"" and [tuple(s) for s in row["spans"]] == [(0, 90)]


@pytest.mark.parametrize("size, hot, states", [(13, 512, 60_000), (5, 2, 60_000), (5, 5, 60_000), (5, 512, 10), (2, 10_000, 10)])
def test_automata_equal_brute_force(spark, size, hot, states):
    texts = corpus(2, 80)
    df = substring_dedup.substring_dedup(frame(spark, texts), size=size, hot=hot, states=states)
    want = sorted(((i, *b) for i, b in enumerate(brute_words(texts, range(len(texts)), size))), key=repr)
    assert got(df, "n_words", "n_removed", "kept_sha256") == want


def test_anchors_of_many_snippets_in_few_documents_are_hot(spark):
    rng = random.Random(8)
    texts = [" ".join(f"the same four words u{rng.randrange(10**9)}" for _ in range(60)) for _ in range(2)]
    unit = repeats.Unit(words=True, size=5, gram=4, longest=32)
    rows = repeats.shared_anchors(common.keyed(frame(spark, texts)), unit, between_ids=True, hot=10).collect()
    assert len(rows) == 2 and all(len(r["hot"]) == 1 for r in rows)


def test_passages_are_removed_and_the_first_copy_stays(spark):
    rng = random.Random(5)
    shared = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    own = [" ".join(f"q{rng.randrange(10**9)}" for _ in range(30)) for _ in range(4)]
    texts = [f"{own[0]}\n{shared}", f"{own[1]}\n{shared}\n{own[2]}", own[3]]
    df = {r["doc_id"]: r for r in substring_dedup.substring_dedup(frame(spark, texts)).collect()}
    assert df[0]["n_removed"] == 0 and df[2]["n_removed"] == 0
    assert df[1]["text"] == f"{own[1]} {own[2]}".encode()
    df = {r["doc_id"]: r for r in suffix_array_dedup.suffix_array_dedup(frame(spark, texts)).collect()}
    assert df[0]["text"] == own[0].encode() and df[2]["n_spans"] == 0 and df[1]["n_spans"] == 1


def test_repeated_ids_rows_and_nulls(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    ids, texts = [1, 1, None, 2, None], [passage, passage, passage, passage + " end", "x " + passage]
    want = sorted(((i, *b) for i, b in zip(ids, brute_words(texts, ids, 13))), key=repr)
    assert got(substring_dedup.substring_dedup(frame(spark, texts, ids)), "n_words", "n_removed", "kept_sha256") == want
    want = sorted(((i, *b) for i, b in zip(ids, brute_bytes(texts, 50))), key=repr)
    assert got(suffix_array_dedup.suffix_array_dedup(frame(spark, texts, ids), size=50), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_a_very_long_text(spark):
    rng = random.Random(9)
    block = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    texts = [long + block, "start " + block, block[:150]]
    df = {r["doc_id"]: r["n_removed"] for r in suffix_array_dedup.suffix_array_dedup_report(frame(spark, texts)).collect()}
    assert df == {0: 5000, 1: 5000, 2: 0}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert suffix_array_dedup.suffix_array_dedup(none).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0


def test_documents_keep_their_columns(spark):
    docs = frame(spark, ["a b c", None])
    for out in (suffix_array_dedup.without_repeated_bytes(docs), substring_dedup.without_repeated_passages(docs), line_dedup.without_frequent_lines(docs, 1)):
        assert out.schema == docs.schema
        assert sorted((r["doc_id"], r["n_lines"], r["_row"]) for r in out.collect()) == [(0, 7, "x"), (1, 7, "x")]


def test_suffix_array_order():
    rng = np.random.default_rng(3)
    for text in (rng.integers(97, 99, 500).astype(np.uint8), np.full(300, 97, np.uint8), rng.integers(0, 256, 400).astype(np.uint8)):
        raw = text.tobytes()
        order = suffix_array_dedup.suffix_array(text, 64)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [raw[i : i + 64] for i in order]
        assert keys == sorted(keys)


def test_kasai_prefixes():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    raw = text.tobytes() + b"\0" * 64
    before = rng.integers(-1, 380, 400).astype(np.int32)
    start, count = np.array([0, 100, 250]), np.array([60, 100, 90])
    order = suffix_array_dedup.suffix_array(text, 400)
    order = order[order <= 380]  # windows of 20 bytes
    phi = np.full(400, -1, dtype=np.int32)
    phi[order[1:]] = order[:-1]
    for neighbours in (before, phi):
        out = suffix_array_dedup.common_prefixes(suffix_array_dedup.eight_bytes(text), neighbours, start, count, 20)
        for s, c in zip(start, count):
            for i in range(s, s + c):
                j, h = int(neighbours[i]), 0
                while j >= 0 and h < 20 and max(i, j) + h < 400 and raw[i + h] == raw[j + h]:
                    h += 1
                if j >= 0:
                    assert h - 8 < out[i] <= h and (out[i] == 20) == (h == 20)


def test_automaton_matching_statistics():
    rng = random.Random(7)
    known = [[rng.choice("abc") for _ in range(30)] for _ in range(3)]
    machine = substring_dedup.SuffixAutomaton()
    for k in known:
        machine.add(k)
    asked = [rng.choice("abcd") for _ in range(50)]
    texts = ["".join(k) for k in known]
    for i, have in enumerate(machine.matching(asked)):
        best = max(n for n in range(i + 2) if any("".join(asked[i + 1 - n : i + 1]) in t for t in texts))
        assert have == best


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    place = line_dedup.MinimalPerfectHash(keys)
    assert sorted(place(keys).tolist()) == list(range(len(keys)))
    assert line_dedup.MinimalPerfectHash(np.zeros(0, np.uint64))(keys[:3]).tolist() == [-1, -1, -1]
    counts = line_dedup.LineCounts(keys, keys + np.uint64(1), np.arange(len(keys)))
    assert counts(keys, keys + np.uint64(1)).tolist() == list(range(len(keys)))
    other = keys + np.uint64(7)
    assert (counts(other, other)[~np.isin(other, keys)] == 0).mean() > 0.99


def brute_lines(texts, least_docs, least_chars):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip("\x20\t\n\v\f\r").translate(lower)
    docs: dict[str, int] = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            docs[k] = docs.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or docs[key(x)] < least_docs]
        out.append((len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


@pytest.mark.parametrize("least_docs, least_chars, probes", [(3, 1, 1 << 20), (2, 4, 3), (1, 1, 1 << 20)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, least_docs, least_chars, probes):
    monkeypatch.setattr(line_dedup, "PROBES_PER_TASK", probes)
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 16)
    rng = random.Random(3)
    pool = ["Common", " common\t", "é", "É", "", "  ", "x" * 50, "ab\r", *[f"line {i}" for i in range(30)]]
    texts = [None, "", "\n\n", "common\ncommon", *["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(40)]]
    texts += texts[6:12]
    df = line_dedup.line_dedup(frame(spark, texts), least_docs, least_chars)
    want = sorted(((i, *b) for i, b in enumerate(brute_lines(texts, least_docs, least_chars))), key=repr)
    assert got(df, "n_lines", "n_dropped", "kept_sha256") == want


def test_words_and_sliding_minimum():
    texts = [b"", b" a  bc\x0b", b"d", b"e f", b"\xc3\xa9"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    start, end, bounds = words(data, off)
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(start, end)] == [w for t in texts for w in t.split()]
    assert np.diff(bounds).tolist() == [len(t.split()) for t in texts]
    a = np.random.default_rng(0).integers(0, 99, 50)
    for w in (1, 2, 3, 7, 50):
        assert sliding_min(a, w).tolist() == [a[i : i + w].min() for i in range(51 - w)]
    assert len(sliding_min(a, 51)) == 0


def test_many_identical_rows_take_linear_work(spark):
    """Copies under one null id share what was found for them; nothing is listed once for each."""
    text = "\n".join(f"line {i} of the same text with more words in it" for i in range(60))
    docs = frame(spark, [text] * 1500, ids=[None] * 1500)
    got = line_dedup.line_dedup_report(docs).collect()
    assert len(got) == 1500 and {(r.n_lines, r.n_dropped) for r in got} == {(60, 60)}
    size = len(text.encode())
    got = suffix_array_dedup.suffix_array_dedup_report(docs, size=200).collect()
    assert len(got) == 1500 and {(r.n_bytes, r.n_removed, r.n_spans) for r in got} == {(size, size, 1)}
    got = substring_dedup.substring_dedup_report(docs, size=13).collect()  # no smaller id: nothing goes
    assert len(got) == 1500 and {r.n_removed for r in got} == {0}
