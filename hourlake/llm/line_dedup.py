"""Drop lines that many documents share, by probing sharded minimal perfect hashes.

Every document's distinct line keys are counted (a plain aggregate). The distinct keys are dealt to shards
of bounded size; a task builds its shard's minimal perfect hash over them, which indexes a fingerprint and a
count array, and the documents' keys of that shard probe these arrays. Only keys that are dropped travel
on to their documents. A shard probed by very many documents (a line in a third of all documents) is
copied to several tasks, each of which takes a part of the probes.

Nulls and empty texts are one empty line and keep it; rows with a null id are documents like others;
identical rows are separate documents when documents are counted; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from hourlake.llm.common import ROW, keyed, like_documents, longs, record, text_list, unsigned
from hourlake.llm.rolling import mix
from hourlake.sources.scratch import written

KEYS_PER_SHARD = 1 << 18
PROBES_PER_TASK = 1 << 20


class MinimalPerfectHash:
    """Places ``n`` distinct 64-bit keys at 0 … n-1 without storing them.

    Levels of bit arrays: a key stays on the first level where no other key has its slot. The rank of its
    bit is its place. Keys that are left after ``LEVELS`` (equal keys at most) go to an exact table.
    """

    LEVELS = 48

    def __init__(self, keys: np.ndarray):
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        placed, left = 0, keys.astype(np.uint64)
        while len(left) and len(self.bits) < self.LEVELS:
            slots = self._slots(left, len(self.bits), 2 * len(left))
            alone = np.bincount(slots, minlength=2 * len(left)) == 1
            self.bits.append(alone)
            self.ranks.append(placed + np.cumsum(alone) - alone)
            placed += int(alone.sum())
            left = left[~alone[slots]]
        rest = np.unique(left)
        self.rest = {int(k): placed + i for i, k in enumerate(rest)}
        self.size = placed + len(rest)

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
        return (mix(keys ^ seed) % np.uint64(max(1, size))).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; a key that was never placed gets any place, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.bits, self.ranks, strict=True)):
            if not len(todo):
                break
            slots = self._slots(keys[todo], level, len(alone))
            hit = alone[slots]
            out[todo[hit]] = rank[slots[hit]]
            todo = todo[~hit]
        for i in todo if self.rest else ():
            out[i] = self.rest.get(int(keys[i]), -1)
        return out


class LineCounts:
    """One shard: fingerprints and document counts behind a minimal perfect hash."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, docs: np.ndarray):
        keys = mix(h1 ^ mix(h2.copy()))
        self.place = MinimalPerfectHash(keys)
        self.prints = np.zeros(self.place.size, dtype=np.uint32)
        self.docs = np.zeros(self.place.size, dtype=np.uint32)
        at = self.place(keys)
        self.prints[at] = h2.astype(np.uint32)
        self.docs[at] = np.minimum(docs, (1 << 32) - 1)

    def __call__(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Document counts of the lines, 0 for lines that are not in the shard."""
        at = self.place(mix(h1 ^ mix(h2.copy())))
        ok = at >= 0
        ok[ok] = self.prints[at[ok]] == h2[ok].astype(np.uint32)
        return np.where(ok, self.docs[np.where(ok, at, 0)], 0) if len(self.docs) else np.zeros(len(at), np.uint32)


def line_keys(text: bytes) -> list[bytes]:
    """Stripped, lower-cased (A-Z) keys of all lines; both calls only know ASCII on bytes."""
    return [line.strip().lower() for line in text.split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "ignore")) >= least)


_PROBE = pa.schema([("_id", pa.int64()), ("_row", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])


def _keys_of(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            digests, sizes = [], []
            for text in text_list(batch):
                own = {xxhash.xxh3_128_digest(k) for k in set(line_keys(text)) if _long_enough(k, least)}
                digests.extend(own)
                sizes.append(len(own))
            h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield record(_PROBE, longs(np.repeat(ids, sizes)), longs(np.repeat(marks, sizes)), longs(h[:, 0]), longs(h[:, 1]))

    return rows


def _probe(least_docs: int):
    def frequent(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = LineCounts(unsigned(right["h1"]), unsigned(right["h2"]), right["docs"].to_numpy())
        many = shard(unsigned(left["h1"]), unsigned(left["h2"])) >= least_docs
        return left.select(_PROBE.names).filter(pa.array(many)).cast(_PROBE)

    return frequent


def frequent_lines(docs: DataFrame, least_docs: int, least_chars: int = 1) -> DataFrame:
    """``_id, _row, h1, h2``: for each document the line keys that ``least_docs`` documents have."""
    lines = keyed(docs).select(*ROW, "text").mapInArrow(_keys_of(least_chars), "_id long, _row long, h1 long, h2 long")
    counts = written(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs")), "line-counts")
    shards = max(1, -(-counts.count() // KEYS_PER_SHARD))
    shard = F.pmod("h1", F.lit(shards)).alias("shard")
    copies = counts.groupBy(shard).agg(F.ceil(F.sum("docs") / PROBES_PER_TASK).cast("int").alias("copies"))
    # identical rows ask once
    probes = lines.distinct().withColumn("shard", shard).join(copies, "shard")
    probes = probes.withColumn("copy", F.pmod(F.hash(*ROW), "copies")).drop("copies")
    arrays = counts.withColumn("shard", shard).join(copies, "shard")
    arrays = arrays.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    by = ("shard", "copy")
    return probes.groupBy(*by).cogroup(arrays.groupBy(*by)).applyInArrow(_probe(least_docs), "_id long, _row long, h1 long, h2 long")


def _drop(with_rest: bool, schema: pa.Schema):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, sha, out = [], [], [], []
            for text, hits in zip(text_list(batch), batch.column("hits").to_pylist(), strict=True):
                lines = text.split(b"\n")
                gone = 0
                if hits:
                    bad = {np.array([h["h1"], h["h2"]], dtype=np.int64).tobytes() for h in hits}
                    stay = [ln for ln in lines if xxhash.xxh3_128_digest(ln.strip().lower()) not in bad]
                    gone = len(lines) - len(stay)
                    text = b"\n".join(stay)
                n_lines.append(len(lines))
                n_dropped.append(gone)
                sha.append(hashlib.sha256(text).hexdigest())
                out.append(text)
            cols = [batch.column("doc_id"), longs(n_lines), longs(n_dropped), pa.array(sha, pa.string())]
            if "text" in schema.names:
                cols.append(pa.array(out, pa.binary()))
            if with_rest:
                cols.append(batch.column("_rest"))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return kept


def _deduped(docs: DataFrame, least_docs: int, least_chars: int, text: bool, rest: bool) -> DataFrame:
    base = keyed(docs, rest)
    hits = frequent_lines(docs, least_docs, least_chars).groupBy(*ROW).agg(F.collect_set(F.struct("h1", "h2")).alias("hits"))
    joined = base.join(hits, list(ROW), "left").drop(*ROW)
    with_rest = "_rest" in base.columns
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"] + ["text"] * text + ["_rest"] * with_rest
    ddl = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", text binary" * text
    if with_rest:
        ddl += f", _rest {base.schema['_rest'].dataType.simpleString()}"
    return joined.mapInArrow(_drop(with_rest, pa.schema([(n, pa.null()) for n in names])), ddl)


def line_dedup(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_sha256`` and the kept ``text`` (binary)."""
    return _deduped(docs, least_docs, least_chars, text=True, rest=False)


def without_frequent_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """``docs`` with the lines dropped from their texts; every document stays, if with an empty text."""
    return like_documents(_deduped(docs, least_docs, least_chars, text=True, rest=True), docs)


def line_dedup_report(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """``line_dedup`` without the texts, which then never leave the Python workers."""
    return _deduped(docs, least_docs, least_chars, text=False, rest=False)
