"""Remove passages that a document with a smaller id has, by suffix automata over reference shards.

Documents are streamed in id order through the automaton of what smaller ids hold: the length of the
longest suffix that the automaton knows (the matching statistic) tells at every word whether the window that ends
there has been seen. What is new is then added. Reference shards are cut by the windows' anchors
(see ``repeats``), so a document only meets the shards that can hold its passages, a shard's
automaton has a bounded size, and none has to be sent to the whole cluster.

Null and empty texts have no words. A null id counts as smaller than every id; documents with equal ids never
remove from each other. Repeated rows get equal results. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourlake.llm.common import keyed, like_documents, longs
from hourlake.llm.repeats import HOT, WORDS, Flags, Unit, compact, covered, repeated_windows, texts_of, with_ranges

#: States of an automaton after which a new one is begun, at the next anchor.
STATES = 60_000


class SuffixAutomaton:
    """All substrings of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: list) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in sequence:
            here = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = here
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[here] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
                    link[q] = link[here] = clone
            last = here

    def matching(self, sequence: list) -> list[int]:
        """At each word, how many words up to it (itself included) are somewhere in what was added."""
        nxt, link, length = self.next, self.link, self.length
        out, state, have = [], 0, 0
        for w in sequence:
            while state and w not in nxt[state]:
                state = link[state]
                have = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                have += 1
            out.append(have)
        return out


def _search(size: int, states: int):
    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, known = Flags(), SuffixAutomaton()
        anchor, now = None, None
        first: dict[bytes, tuple[int, np.ndarray]] = {}  # of this anchor: each snippet's first id and its flags there
        new: list[list[bytes]] = []  # of this id: added when the id has been searched
        for batch in batches:
            for row, doc_id, key, lo, windows, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != anchor or doc_id != now:
                    for sequence in new:
                        known.add(sequence)
                    new, now = [], doc_id
                if key != anchor:
                    anchor, first = key, {}
                    if len(known.next) > states:
                        known = SuffixAutomaton()
                if text in first and first[text][0] < doc_id:
                    out.all(row, doc_id, lo, windows)
                    continue
                if text not in first:
                    sequence = text.split(b" ")
                    seen = np.array(known.matching(sequence)[size - 1 :]) >= size
                    first[text] = (doc_id, seen)
                    if not seen.all():
                        new.append(sequence)
                seen = first[text][1]
                if seen.any():
                    out.add(row, doc_id, lo, seen)
            yield out.take()

    return flags


def _cut(unit: Unit, with_text: bool, with_rest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha, texts = [], [], [], []
            ids, ranges = batch.column("_id").to_pylist(), batch.column("ranges").to_pylist()
            for doc_id, text, found in zip(ids, texts_of(batch), ranges, strict=True):
                words = text.split()
                n = len(words)
                for a, b in reversed(covered(found, doc_id, unit.size, n)):
                    del words[a:b]
                n_words.append(n)
                n_removed.append(n - len(words))
                kept = b" ".join(words)
                sha.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
            cols = {"doc_id": batch.column("doc_id"), "n_words": longs(n_words), "n_removed": longs(n_removed), "kept_sha256": pa.array(sha, pa.string())}
            if with_text:
                cols["text"] = pa.array(texts, pa.binary())
            if with_rest:
                cols["_rest"] = batch.column("_rest")
            yield pa.RecordBatch.from_pydict(cols)

    return rows


def _deduped(docs: DataFrame, size: int, text: bool, rest: bool, hot: int, states: int) -> DataFrame:
    unit = Unit(words=True, size=size, gram=min(WORDS.gram, size), longest=max(WORDS.longest, size))
    packed = compact(keyed(docs, rest))  # one shuffle of it serves both the search and the cut
    flags = repeated_windows(keyed(docs), packed, unit, between_ids=True, search=_search(size, states), hot=hot)
    joined = with_ranges(packed, flags)
    with_rest = "_rest" in joined.columns
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text binary" * text
    if with_rest:
        ddl += f", _rest {joined.schema['_rest'].dataType.simpleString()}"
    return joined.mapInArrow(_cut(unit, text, with_rest), ddl)


def substring_dedup(docs: DataFrame, size: int = 13, hot: int = HOT, states: int = STATES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` and the kept words as ``text`` (binary)."""
    return _deduped(docs, size, text=True, rest=False, hot=hot, states=states)


def substring_dedup_report(docs: DataFrame, size: int = 13) -> DataFrame:
    """``substring_dedup`` without the texts, which then never leave the Python workers."""
    return _deduped(docs, size, text=False, rest=False, hot=HOT, states=STATES)


def without_repeated_passages(docs: DataFrame, size: int = 13) -> DataFrame:
    """``docs`` with the passages cut from their texts; every document stays."""
    return like_documents(_deduped(docs, size, text=True, rest=True, hot=HOT, states=STATES), docs)
