"""Finding windows that texts share: what the suffix-array and the suffix-automaton dedup have in common.

A window is ``size`` consecutive values (bytes or words) of one document. Its *anchor* is its minimizer, the
least hash of the shorter runs in it, so equal windows have equal anchors wherever they are. Neighbouring
windows mostly share an anchor; such a run of windows with the values they cover is a *snippet*.

1. Anchors of all documents are counted (map-side first); an anchor seen only once can't belong to a repeat.
2. Documents with shared anchors emit their snippets, which are dealt to tasks by anchor. Tasks take them in
   order of anchor and cut that stream into shards of bounded size, which the two operators search.
3. Snippets of anchors with more than ``hot`` of them (a line in a third of all documents) don't go to one task as
   they are: equal ones are collapsed first. If more than ``hot`` different ones are left, they are cut
   into single windows, and these are aggregated. All of this is exact and bounded for any group.

The result is ranges of repeated windows per document. Texts cross the network once, dealt by row and compressed. Keys
that are only there to bring rows together are cut to as many bits as keep chance meetings rare at any size
(a chance meeting costs some work, never a wrong result: ids and texts are compared).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from hourlake.llm.common import larger, longs, record, signed, text_bytes, unsigned
from hourlake.llm.rolling import U64, byte_values, grams, mix, pieces, prefix, runs, sliding_min, word_hashes, words

#: Bits of anchors and of rows' keys.
ANCHOR = (1 << 48) - 1
ROW_KEY = (1 << 40) - 1
#: Snippets of one anchor that a single task takes (a few megabytes at most).
HOT = 8192


@dataclass(frozen=True)
class Unit:
    """What windows are made of: ``words`` or bytes, their size, the minimizer's length and a run's longest length."""

    words: bool
    size: int
    gram: int
    longest: int


BYTES = Unit(words=False, size=200, gram=50, longest=256)
WORDS = Unit(words=True, size=13, gram=4, longest=32)


@dataclass
class Runs:
    """Runs of windows in a piece of a batch; ``lo`` and ``hi`` count from the first value of their document."""

    doc: np.ndarray
    anchor: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    times: np.ndarray  # 2 if windows inside the run can be equal, else 1
    first: np.ndarray  # byte where the run's first window begins, and where its last one ends
    end: np.ndarray


def find_runs(data: np.ndarray, off: np.ndarray, unit: Unit) -> Runs:
    if unit.words:
        start, stop, bounds = words(data, off)
        values = word_hashes(data, start, stop)
    else:
        bounds, values = off, byte_values(data)
    g = grams(prefix(values), unit.gram)
    span = unit.size - unit.gram + 1
    # least by 32 bits of the hash, the leftmost of equals: the same place in equal windows
    packed = (g & U64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    at = (sliding_min(packed, span) & U64(0xFFFFFFFF)).astype(np.int64)
    length = np.diff(bounds)
    fits = length >= unit.size
    step = np.zeros(len(values) + 1, dtype=np.int32)
    np.add.at(step, bounds[:-1][fits], 1)
    np.add.at(step, bounds[1:][fits] - unit.size + 1, -1)
    window = np.flatnonzero(np.cumsum(step)[: len(at)] > 0)
    if not len(window):
        none = np.zeros(0, np.int64)
        return Runs(none, np.zeros(0, np.uint64), none, none, none, none, none)
    at = at[window]
    anchor = g[at]
    fresh = np.zeros(len(window), dtype=bool)
    fresh[1:] = window[1:] != window[:-1] + 1
    doc_first = np.zeros(len(values) + 1, dtype=bool)
    doc_first[bounds[:-1]] = True
    fresh |= doc_first[window]
    a, z = runs(anchor, fresh, unit.longest)
    moved = np.zeros(len(window) + 1, dtype=np.int64)
    np.cumsum(np.append(at[1:] != at[:-1], False), out=moved[1:])
    doc = np.searchsorted(bounds, window[a], side="right") - 1
    base = bounds[doc]
    last = window[z - 1] + unit.size
    return Runs(
        doc,
        anchor[a] & U64(ANCHOR),
        window[a] - base,
        window[z - 1] + 1 - base,
        1 + (moved[z - 1] > moved[a]),
        start[window[a]] if unit.words else window[a],
        stop[last - 1] if unit.words else last,
    )


# ---------------------------------------------------------------- documents


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = pa.array([pack(t or b"") for t in batch.column(at).to_pylist()], pa.binary())
        yield batch.set_column(at, "text", texts)


def compact(docs: DataFrame) -> DataFrame:
    """``keyed`` documents with shorter row keys and compressed texts, as they are shuffled."""
    short = docs.withColumn("_row", F.col("_row").bitwiseAND(F.lit(ROW_KEY)))
    return short.mapInArrow(_compressed, short.schema)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of ``compact`` documents."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(t) for t in batch.column("text").to_pylist()]


# ---------------------------------------------------------------- anchors


def _anchors(unit: Unit):
    schema = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("anchor", pa.int64()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, off = text_bytes(batch)
            for i, j in pieces(off):
                r = find_runs(data[off[i] : off[j]], off[i : j + 1] - off[i], unit)
                if not len(r.doc):
                    continue
                order = np.lexsort((r.anchor, r.doc))
                doc, anchor = r.doc[order], r.anchor[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
                at = np.flatnonzero(new)
                times = np.add.reduceat(r.times[order], at)
                yield record(schema, longs(marks[i + doc[at]]), longs(ids[i + doc[at]]), signed(anchor[at]), longs(times))

    return lambda batches: larger(rows(batches))


def shared_anchors(docs: DataFrame, unit: Unit, between_ids: bool, hot: int) -> DataFrame:
    """``_row, anchors, hot``: per document its anchors that can belong to repeats, the hot ones apart.

    ``between_ids``: only repeats between documents with different ids count.
    """
    each = docs.select("_id", F.col("_row").bitwiseAND(F.lit(ROW_KEY)).alias("_row"), "text").mapInArrow(_anchors(unit), "_row long, _id long, anchor long, n long")
    if between_ids:
        known = each.groupBy("anchor").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.sum("n").alias("n")).where("lo < hi")
    else:
        known = each.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    known = known.select("anchor", (F.col("n") > hot).alias("is_hot"))
    linked = each.select("_row", "anchor").join(known, "anchor")
    return linked.groupBy("_row").agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("anchor"))).alias("anchors"), F.collect_set(F.when(F.col("is_hot"), F.col("anchor"))).alias("hot")
    )


# ---------------------------------------------------------------- snippets

SNIPPET = "_row long, _id long, anchor long, lo long, windows long, snippet binary"
_SNIPPET = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("anchor", pa.int64()), ("lo", pa.int64()), ("windows", pa.int64()), ("snippet", pa.binary())])


def _snippets(unit: Unit, wanted: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            lists = batch.column(wanted)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            pair = _pair(np.repeat(np.arange(len(ids)), np.diff(ends)), unsigned(lists.flatten()))
            texts = texts_of(batch)
            data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
            for i, j in pieces(off):
                if ends[i] == ends[j]:
                    continue
                part = data[off[i] : off[j]]
                r = find_runs(part, off[i : j + 1] - off[i], unit)
                keep = np.flatnonzero(np.isin(_pair(r.doc + i, r.anchor), pair[ends[i] : ends[j]]))
                if not len(keep):
                    continue
                raw = part.tobytes()
                found = [raw[a:b] for a, b in zip(r.first[keep].tolist(), r.end[keep].tolist(), strict=True)]
                if unit.words:
                    found = [b" ".join(t.split()) for t in found]
                doc = r.doc[keep] + i
                yield record(_SNIPPET, longs(marks[doc]), longs(ids[doc]), signed(r.anchor[keep]), longs(r.lo[keep]), longs(r.hi[keep] - r.lo[keep]), pa.array(found, pa.binary()))

    return lambda batches: larger(rows(batches))


def _pair(doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return mix(anchor ^ mix(doc.astype(np.uint64) + U64(1)))


FLAGS = "_row long, _id long, a long, b long"
_FLAGS = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


class Flags:
    """Collects ranges of repeated windows, as ``FLAGS`` rows."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int]] = []

    def add(self, row: int, doc_id: int, lo: int, flags: np.ndarray) -> None:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
        self.rows.extend((row, doc_id, lo + a, lo + b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))

    def all(self, row: int, doc_id: int, lo: int, windows: int) -> None:
        self.rows.append((row, doc_id, lo, lo + windows))

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[]] * 4
        self.rows = []
        return record(_FLAGS, *[pa.array(c, pa.int64()) for c in cols])


# ---------------------------------------------------------------- hot anchors


def _windows_of(unit: Unit):
    schema = pa.schema([("key", pa.int64()), ("at", pa.int64()), ("w", pa.binary()), ("n", pa.int64()), ("least", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, text, n, least in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if unit.words:
                    parts = text.split(b" ")
                    each = [b" ".join(parts[i : i + unit.size]) for i in range(len(parts) - unit.size + 1)]
                else:
                    each = [text[i : i + unit.size] for i in range(len(text) - unit.size + 1)]
                out.extend((key, i, xxhash.xxh3_128_digest(w), n, least) for i, w in enumerate(each))
                if len(out) > 1 << 16:
                    yield record(schema, *[pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)])
                    out = []
            if out:
                yield record(schema, *[pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)])

    return rows


def _hot_flags(snippets: DataFrame, unit: Unit, between_ids: bool, search: Callable, hot: int) -> DataFrame:
    """Repeated windows of hot anchors, from one row for each different snippet."""
    keyed_ = snippets.withColumn("key", F.xxhash64("anchor", "snippet"))
    distinct = keyed_.groupBy("anchor", "snippet", "windows", "key").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("least"))
    many = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).where(F.col("different") > hot).select("anchor")
    # a group that fits a task after all: searched like any other, in the name of each snippet's least id
    few = distinct.join(many, "anchor", "left_anti")
    few = few.select(F.col("key").alias("_row"), F.col("least").alias("_id"), "anchor", F.lit(0).cast("long").alias("lo"), "windows", "snippet")
    found = few.repartition("anchor").sortWithinPartitions("anchor", "_id").mapInArrow(search, FLAGS)
    found = found.select(F.col("_row").alias("key"), "a", "b")
    # the others by window
    each = distinct.join(many, "anchor", "left_semi").select("key", "snippet", "n", "least")
    each = each.mapInArrow(_windows_of(unit), "key long, at long, w binary, n long, least long")
    known = each.groupBy("w").agg(F.sum("n").alias("all"), F.min("least").alias("first"))
    again = F.col("first") < F.col("least") if between_ids else F.col("all") > 1
    found = found.union(each.join(known, "w").where(again).select("key", F.col("at").alias("a"), (F.col("at") + 1).alias("b")))
    ranges = found.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    # back to the rows: copies of a snippet repeat all of it, the first (or only) one has what was found
    copy = F.col("_id") > F.col("least") if between_ids else F.col("n") > 1
    own = keyed_.select("_row", "_id", "lo", "windows", "key").join(distinct.select("key", "n", "least"), "key").join(ranges, "key", "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("windows").alias("b")))
    parts = F.explode(F.when(copy, whole).otherwise(F.col("ranges"))).alias("r")
    return own.select("_row", "_id", "lo", parts).select("_row", "_id", (F.col("lo") + F.col("r.a")).alias("a"), (F.col("lo") + F.col("r.b")).alias("b"))


# ---------------------------------------------------------------- all together


def repeated_windows(docs: DataFrame, packed: DataFrame, unit: Unit, between_ids: bool, search: Callable, hot: int = HOT) -> DataFrame:
    """``FLAGS`` rows for ``keyed`` documents and the same as ``compact`` ones. ``search`` maps batches of snippets, sorted by anchor and id, to such rows."""
    by_row = shared_anchors(docs, unit, between_ids, hot)
    linked = packed.join(by_row, "_row")
    cold = linked.where(F.size("anchors") > 0).mapInArrow(_snippets(unit, "anchors"), SNIPPET)
    cold = cold.repartition("anchor").sortWithinPartitions("anchor", "_id").mapInArrow(search, FLAGS)
    warm = linked.where(F.size("hot") > 0).mapInArrow(_snippets(unit, "hot"), SNIPPET)
    return cold.union(_hot_flags(warm, unit, between_ids, search, hot))


def with_ranges(packed: DataFrame, flags: DataFrame) -> DataFrame:
    """``compact`` documents with ``ranges``, the ranges of repeated windows (those of other ids with an equal row hash included).

    Identical rows find the same ranges, each of which counts once: a set, collapsed map-side.
    """
    return packed.join(flags.groupBy("_row").agg(F.collect_set(F.struct("_id", "a", "b")).alias("ranges")), "_row", "left")


def covered(ranges: list[dict] | None, doc_id: int, size: int, n: int) -> list[tuple[int, int]]:
    """Maximal runs of values that repeated windows cover, in order."""
    out: list[list[int]] = []
    for a, b in sorted((r["a"], min(n, r["b"] + size - 1)) for r in ranges or () if r["_id"] == doc_id):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
