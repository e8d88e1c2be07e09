"""Remove bytes that long repeated strings cover, by suffix arrays of bounded shards.

Snippets that can hold repeats arrive sorted by anchor (see ``repeats``). A task cuts this stream into shards, sorts
each shard's suffixes by Larsson-Sadakane refinement (doubling the sorted depth and touching only groups that
are still tied), and takes common prefixes of neighbours by Kasai's rule. A window whose neighbour
shares all of it is repeated. If an anchor goes on in the next shard, its sorted windows are merged with
that shard's by binary search. Equal snippets are stored once, with how often they occur.

Null and empty texts have no bytes. Documents are rows: repeated rows, and rows with a null id, repeat each
other. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourlake.llm.common import keyed, like_documents, longs
from hourlake.llm.repeats import BYTES, HOT, Flags, Unit, compact, covered, repeated_windows, texts_of, with_ranges

#: Bytes of snippets whose suffixes are sorted together.
SHARD = 1 << 20


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k : k + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int, head: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes (at least); ties stay in any order."""
    n = len(text)
    head = eight_bytes(text) if head is None else head
    order = np.argsort(head).astype(np.int32)
    ranked = head[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    slots = np.arange(n, dtype=np.int32)
    rank = np.empty(n + 1, dtype=np.int32)
    rank[n] = -1

    def settle(slots: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Rank the groups that begin at ``new``; return which slots are still tied."""
        begins = np.flatnonzero(new)
        size = np.diff(np.append(begins, len(slots)))
        rank[order[slots]] = np.repeat(slots[begins], size)
        return np.repeat(size > 1, size)

    tied = settle(slots, new)
    sorted_to = 8
    while sorted_to < depth and tied.any():
        slots = slots[tied]
        suffix = order[slots]
        after = rank[np.minimum(suffix + sorted_to, n)]
        key = (rank[suffix].astype(np.int64) << 32) | (after + 1)
        by = np.argsort(key)
        key = key[by]
        order[slots] = suffix[by]
        new = np.ones(len(slots), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        tied = settle(slots, new)
        sorted_to *= 2
    return order


def common_prefixes(head: np.ndarray, before: np.ndarray, start: np.ndarray, count: np.ndarray, cap: int) -> np.ndarray:
    """Kasai's rule for many stretches of text at once: common prefix (up to ``cap``) of each place with ``before``.

    Stretch k has the places ``start[k]`` … ``start[k] + count[k] - 1``; all stretches step on together. If the neighbour
    steps on too, just one byte of the common prefix is lost and the comparison goes on from there. Otherwise it
    begins anew: the rule's bound for that case needs all suffixes in full order, and here only windows are, up to a depth.
    Bytes are compared eight at a time, so what is below ``cap`` may be up to seven bytes short; ``cap`` itself is exact.
    """
    out = np.zeros(len(head), dtype=np.int32)
    lanes = np.argsort(-count, kind="stable")
    start, count = start[lanes].astype(np.int64), count[lanes]
    have = np.zeros(len(start), dtype=np.int64)
    last = np.full(len(start), -2, dtype=np.int64)
    width = min(8, cap)
    rest = np.uint64(64 - 8 * width)
    for t in range(int(count[0]) if len(count) else 0):
        m = int(np.searchsorted(-count, -t, side="left"))  # stretches longer than t
        here, there = start[:m] + t, before[start[:m] + t].astype(np.int64)
        h = np.where(there == last[:m] + 1, np.maximum(have[:m] - 1, 0), 0)
        todo = np.flatnonzero(there >= 0)
        while len(todo):
            at = np.minimum(h[todo], cap - width)  # windows have ``cap`` bytes, so this stays inside them
            same = (head[here[todo] + at] ^ head[there[todo] + at]) >> rest == 0
            todo, at = todo[same], at[same] + width
            h[todo] = at
            todo = todo[at < cap]
        have[:m], last[:m] = h, np.where(there >= 0, there, -2)
        out[here] = h
    return out


@dataclass
class Snippet:
    """A distinct snippet: its rows (row, id, first window) and which of its windows are repeated."""

    anchor: int
    text: bytes
    windows: int
    rows: list[tuple[int, int, int]] = field(default_factory=list)
    flags: np.ndarray | None = None


def search_shard(snippets: list[Snippet], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets the flags of a shard's snippets. Returns where its windows begin, in suffix order, and where snippets do."""
    text = np.frombuffer(b"".join(s.text for s in snippets), dtype=np.uint8)
    lengths = np.array([len(s.text) for s in snippets])
    start = np.cumsum(lengths) - lengths
    count = lengths - size + 1
    head = eight_bytes(text)
    order = suffix_array(text, size, head)
    is_window = np.zeros(len(text) + 1, dtype=np.int8)
    is_window[start] += 1
    is_window[start + count] -= 1
    order = order[np.cumsum(is_window[:-1])[order] > 0]  # suffixes that begin a window; equal windows are neighbours
    before = np.full(len(text), -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    full = common_prefixes(head, before, start, count, size) >= size
    repeated = full.copy()
    repeated[before[order][full[order]]] = True
    for k, s in enumerate(snippets):
        s.flags = repeated[start[k] : start[k] + count[k]] if len(s.rows) < 2 else np.ones(count[k], dtype=bool)
    return order, start


def _windows_of(snippets: list[Snippet], size: int) -> np.ndarray:
    """All windows of the snippets, one after the other, as fixed-width strings."""
    rows = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(s.text, np.uint8), size) for s in snippets]
    return np.ascontiguousarray(np.concatenate(rows)).view(f"S{size}").ravel()


def merge_by_binary_search(old: list[Snippet], new: list[Snippet], size: int, order: np.ndarray, start: np.ndarray) -> None:
    """Flags windows of an anchor that are in both an earlier shard and a later one, whose sorted windows are searched.

    Equal windows are neighbours in the later shard, so a search for their first and last place finds all of them.
    """
    owner = np.searchsorted(start, order, side="right") - 1
    mine_too = np.array([s.anchor == old[0].anchor for s in new])[owner]
    order, owner = order[mine_too], owner[mine_too]
    if not len(order):
        return
    text = np.frombuffer(b"".join(s.text for s in new), np.uint8)
    sorted_ = np.lib.stride_tricks.sliding_window_view(text, size)[order].view(f"S{size}").ravel()
    met = np.zeros(len(order) + 1, dtype=np.int64)
    for k in range(0, len(old), 64):
        some = old[k : k + 64]
        asked = _windows_of(some, size)
        first, last = np.searchsorted(sorted_, asked, side="left"), np.searchsorted(sorted_, asked, side="right")
        hit = last > first
        np.add.at(met, first[hit], 1)
        np.add.at(met, last[hit], -1)
        for s, flags in zip(some, np.split(hit, np.cumsum([s.windows for s in some])[:-1]), strict=True):
            s.flags = s.flags | flags
    found = np.flatnonzero(np.cumsum(met[:-1]) > 0)
    flagged = np.zeros(len(text), dtype=bool)
    flagged[order[found]] = True
    for k in np.unique(owner[found]):
        new[k].flags = new[k].flags | flagged[start[k] : start[k] + new[k].windows]


def _search(size: int, shard: int):
    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Flags()
        held: list[Snippet] = []  # of earlier shards, with the anchor that goes on
        now: list[Snippet] = []
        by_text: dict[bytes, Snippet] = {}  # of the anchor that goes on, in all its shards
        room = 0

        def close(anchor: int | None) -> None:
            """Search the shard; write all but the snippets of ``anchor``, which goes on."""
            nonlocal held, now, room
            if now:
                order, start = search_shard(now, size)
                if held:
                    merge_by_binary_search(held, now, size, order, start)
            ready = held + now
            held = [s for s in ready if s.anchor == anchor]
            now, room = [], 0
            for s in ready:
                if s.anchor != anchor:
                    repeated = np.ones(s.windows, dtype=bool) if len(s.rows) > 1 else s.flags
                    if repeated.any():
                        for row, doc_id, lo in s.rows:
                            out.add(row, doc_id, lo, repeated)

        anchor = None
        for batch in batches:
            for row, doc_id, key, lo, windows, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != anchor:
                    if room >= shard or held:
                        close(None)
                    anchor, by_text = key, {}
                elif room >= shard:
                    close(anchor)
                s = by_text.get(text)
                if s is None:
                    s = by_text[text] = Snippet(key, text, windows)
                    now.append(s)
                    room += len(text)
                s.rows.append((row, doc_id, lo))
            yield out.take()
        close(None)
        yield out.take()

    return flags


def _cut(unit: Unit, with_text: bool, with_rest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, sha, texts, spans = [], [], [], [], [], []
            ids, ranges = batch.column("_id").to_pylist(), batch.column("ranges").to_pylist()
            for doc_id, text, found in zip(ids, texts_of(batch), ranges, strict=True):
                gone = covered(found, doc_id, unit.size, len(text))
                kept = text
                if gone:
                    cuts = [0, *[x for ab in gone for x in ab], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                n_bytes.append(len(text))
                n_removed.append(len(text) - len(kept))
                n_spans.append(len(gone))
                sha.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
                spans.append([{"start": a, "end": b} for a, b in gone])
            cols = {"doc_id": batch.column("doc_id"), "n_bytes": longs(n_bytes), "n_removed": longs(n_removed), "n_spans": longs(n_spans), "kept_sha256": pa.array(sha, pa.string())}
            if with_text:
                cols["text"] = pa.array(texts, pa.binary())
                cols["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            if with_rest:
                cols["_rest"] = batch.column("_rest")
            yield pa.RecordBatch.from_pydict(cols)

    return rows


def _deduped(docs: DataFrame, size: int, text: bool, rest: bool, hot: int, shard: int) -> DataFrame:
    unit = Unit(words=False, size=size, gram=max(1, size // 4), longest=max(size, BYTES.longest))
    packed = compact(keyed(docs, rest))  # one shuffle of it serves both the search and the cut
    flags = repeated_windows(keyed(docs), packed, unit, between_ids=False, search=_search(size, shard), hot=hot)
    joined = with_ranges(packed, flags)
    with_rest = "_rest" in joined.columns
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    ddl += ", text binary, spans array<struct<start: long, end: long>>" * text
    if with_rest:
        ddl += f", _rest {joined.schema['_rest'].dataType.simpleString()}"
    return joined.mapInArrow(_cut(unit, text, with_rest), ddl)


def suffix_array_dedup(docs: DataFrame, size: int = 200, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, the kept bytes and the removed spans."""
    return _deduped(docs, size, text=True, rest=False, hot=hot, shard=shard)


def suffix_array_dedup_report(docs: DataFrame, size: int = 200) -> DataFrame:
    """``suffix_array_dedup`` without texts and spans, which then never leave the Python workers."""
    return _deduped(docs, size, text=False, rest=False, hot=HOT, shard=SHARD)


def without_repeated_bytes(docs: DataFrame, size: int = 200) -> DataFrame:
    """``docs`` with the repeated bytes cut from their texts (what is no UTF-8 afterwards is replaced); every document stays."""
    return like_documents(_deduped(docs, size, text=True, rest=True, hot=HOT, shard=SHARD), docs)
