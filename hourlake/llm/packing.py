"""Pack token streams into full sequences with a controlled mixture of sources.

Every source is a queue of tokens, its documents one after the other. Sequences are filled by deficit round-robin:
a queue may emit a token whenever its share of what has been emitted lags behind its weight. The deficits that a
sequence leaves are carried to the next one, across tasks too, without any sequential pass: token x of a queue
of weight w is due at time (2x + 1) / w, so how much of each queue the first R tokens hold is a function of R
alone, and every task computes the boundaries of just the sequences that its documents fall in. Within a
sequence the queues follow each other, so a document is cut only where its queue's turn ends.

By default weights are the queues' own token counts: all queues drain together, every sequence has the corpus
mixture, and only the last one has less than ``length`` tokens. A source with less than 1/64 of the weight has less
than a run of ``length`` / 64 tokens due in a sequence; its deficit is carried until a whole run is due, which keeps its
documents from being cut to crumbs. The runs of all these sources, each at its own due time, are sorted and summed up
by Spark; in that order they are one queue to the rest, whose rate is at any time that of the sources still in it. So
no task holds a list of these sources, however many there are.

Tokens are written once, with the documents of a batch in one row, and are never shuffled. A null or empty text is
its end token alone. A null source is the empty name; null ids and repeated rows are documents like others.
Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hourlake.sources.scratch import written

LENGTH = 1024
END = 0
#: A source with less than this part of the weight emits whole runs, this part of a sequence long.
OWN_QUEUE = 1 / 64
#: Tokens whose runs are summed up in one task.
SPAN = 1 << 22
#: Bytes of text whose tokens make one row.
CHUNK = 1 << 20

_CHUNK = (
    "chunk long, docs array<long>, sources array<int>, lengths array<long>, ids binary, totals array<struct<source: string, tokens: long>>"
)


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The tokenizer and, if its rank file lies beside it, a faster reader of the same vocabulary."""
    import base64
    from pathlib import Path

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ranks = Path(path).with_suffix(".tiktoken")
    fast = None
    if ranks.exists():
        import public_tokenizers
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.read_bytes().splitlines() if line)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, fast, special


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Token ids of the texts without special tokens added.

    The rank reader gives the same ids, four times as fast, for texts of Latin letters without a
    special token's string; all others go through the tokenizer itself.
    """
    tokenizer, fast, special = _encoders(path)
    out: list[np.ndarray | None] = []
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        plain = fast is not None and not any(s in raw for s in special) and (text.isascii() or np.frombuffer(raw, np.uint8).max() < 0xCA)
        out.append(np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4") if plain else None)
    slow = [i for i, ids in enumerate(out) if ids is None]
    for i, e in zip(slow, tokenizer.encode_batch([texts[i] for i in slow], add_special_tokens=False), strict=True):
        out[i] = np.array(e.ids, dtype="<u4")
    return out


def _tokenized(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ordinal = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts, sources = (c.to_pylist() for c in batch.columns)
            i = 0
            while i < len(ids):
                j, room = i, 0
                while j < len(ids) and (j == i or room + len(texts[j] or "") <= CHUNK):
                    room += len(texts[j] or "")
                    j += 1
                end = np.array([END], dtype="<u4")
                tokens = [np.concatenate([x, end]) for x in encode([t or "" for t in texts[i:j]], path)]
                names = sorted({s or "" for s in sources[i:j]})
                place = {s: k for k, s in enumerate(names)}
                which = [place[s or ""] for s in sources[i:j]]
                totals = [0] * len(names)
                for k, x in zip(which, tokens, strict=True):
                    totals[k] += len(x)
                flat = np.concatenate(tokens)
                flat = flat.astype("<u2") if _encoders(path)[0].get_vocab_size() <= 1 << 16 else flat
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([(task << 32) | ordinal], pa.int64()),
                        "docs": pa.array([ids[i:j]], pa.list_(pa.int64())),
                        "sources": pa.array([which], pa.list_(pa.int32())),
                        "lengths": pa.array([[len(x) for x in tokens]], pa.list_(pa.int64())),
                        "ids": pa.array([flat.tobytes()], pa.binary()),
                        "totals": pa.array([[{"source": s, "tokens": n} for s, n in zip(names, totals, strict=True)]], pa.list_(pa.struct([("source", pa.string()), ("tokens", pa.int64())]))),
                    }
                )
                ordinal += 1
                i = j

    return rows


Bend = tuple[np.ndarray, np.ndarray]


def bend_of(weights: list[float], tokens: list[int]) -> Bend:
    """Times, and how many tokens sources of these weights have emitted by then; linear in between."""
    w, n = np.array([*weights, 1.0]), np.array([*tokens, 0], dtype=np.float64)
    times = np.unique(np.concatenate([[0.0], 2 * n / w]))
    return times, np.array([np.minimum(n, w * t / 2).sum() for t in times])


def _due(t: np.ndarray, weights: np.ndarray, tokens: np.ndarray, bend: Bend | None) -> np.ndarray:
    """How many tokens of each queue are due before each time."""
    fluid = t[:, None] * weights[None, :] / 2
    if bend is not None:
        fluid[:, -1] = np.interp(t, *bend)
    return np.clip(np.ceil(fluid - 0.5), 0, tokens[None, :]).astype(np.int64)


def _time(x: np.ndarray, queue: np.ndarray, weights: np.ndarray, bend: Bend | None) -> np.ndarray:
    """When token ``x`` of the queue is due."""
    t = (2 * x + 1) / weights[queue]
    return t if bend is None else np.where(queue == len(weights) - 1, np.interp(x + 0.5, bend[1], bend[0]), t)


def emitted(upto: np.ndarray, weights: np.ndarray, tokens: np.ndarray, bend: Bend | None = None) -> np.ndarray:
    """How many tokens of each queue are among the first ``upto`` ones (one row for each value).

    Token x of queue q is due at (2x + 1) / weight, those of the last queue as ``bend`` says, if given; equal times go
    in the order of the queues. A time by which not
    quite enough are due is guessed from the weights' sum (or bisected, once queues have run empty);
    the last few tokens are added in their order, so the result does not depend on the guess.
    """
    upto = np.minimum(upto.astype(np.int64), int(tokens.sum()))
    due = lambda t: _due(t, weights, tokens, bend)
    slack, total = len(tokens) + 1, float(weights.sum())
    low = np.maximum(2.0 * (upto - slack) / total, 0.0)
    far = upto - due(low).sum(axis=1) > 3 * slack
    if far.any():
        some = upto[far]
        a, b = low[far], np.full(len(some), max(float((2 * tokens / weights).max()), 0.0 if bend is None else bend[0][-1]) + 1)
        for _ in range(100):
            mid = (a + b) / 2
            fits = due(mid).sum(axis=1) <= some
            a, b = np.where(fits, mid, a), np.where(fits, b, mid)
        low[far] = a
    have = np.maximum(due(low) - 1, 0)  # one less: rounding may have counted a token that is due just then
    left = upto - have.sum(axis=1)
    each = np.arange(len(tokens))
    wait = np.where(have < tokens, _time(have, np.broadcast_to(each, have.shape), weights, bend), np.inf)
    rows = np.flatnonzero(left > 0)
    while len(rows):
        q = wait[rows].argmin(axis=1)
        have[rows, q] += 1
        now = have[rows, q]
        wait[rows, q] = np.where(now < tokens[q], _time(now, q, weights, bend), np.inf)
        left[rows] -= 1
        rows = rows[left[rows] > 0]
    return have


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _windows(queue: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, weights: np.ndarray, tokens: np.ndarray, bend: Bend | None) -> tuple[np.ndarray, np.ndarray]:
    """Sequences that hold tokens ``lo`` … ``hi`` - 1 of these queues (and their neighbours), with all queues' counts
    before each, and after each."""
    last = int(-(-tokens.sum() // length)) - 1
    rank = lambda x: _due(_time(x, queue, weights, bend), weights, tokens, bend).sum(axis=1)  # noqa: E731  tokens before, about
    first, final = rank(lo) // length - 1, rank(hi - 1) // length + 1
    size = np.minimum(final, last) + 1 - np.maximum(first, 0)
    ids = np.unique(np.repeat(np.maximum(first, 0) - np.cumsum(size) + size, size) + np.arange(size.sum()))
    edges, place = np.unique(np.concatenate([ids, ids + 1]), return_inverse=True)
    return ids, emitted(edges * length, weights, tokens, bend)[place]


def _cut(names: list[str], weights: list[float], tokens: list[int], bend: Bend, run: int, length: int, with_ids: bool):
    order = {s: i for i, s in enumerate(names)}
    w, t = np.array(weights, dtype=np.float64), np.array(tokens, dtype=np.int64)
    common = len(names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield piece_rows(r)

    def piece_rows(r: dict) -> pa.RecordBatch:
        sizes = np.array(r["lengths"], dtype=np.int64)
        sources = np.array(r["sources"], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        wide = len(r["ids"]) // max(1, int(sizes.sum()))
        ids = np.frombuffer(r["ids"], dtype="<u2" if wide == 2 else "<u4").astype("<u4")
        start = {x["at"]: x["start"] for x in r["starts"]}
        runs: dict[int, list[tuple[int, int]]] = {}
        for x in r["runs"] or ():
            runs.setdefault(x["at"], []).append((x["run"], x["place"]))
        # stretches of documents that are whole in their queue: the document, where in it, where in the queue, how long
        stretches: dict[int, list[list[np.ndarray]]] = {}
        for k in np.unique(sources).tolist():
            docs = np.flatnonzero(sources == k)
            begins = start[k] + np.cumsum(sizes[docs]) - sizes[docs]
            end = start[k] + int(sizes[docs].sum())
            q = order.get(r["totals"][k]["source"], common)
            if q == common:
                number, at = np.array(sorted(runs[k]), dtype=np.int64).T
                x = np.unique(np.concatenate([begins, number[1:] * run]))
                of = np.searchsorted(number, x // run)
                in_queue = at[of] + x - number[of] * run
            else:
                x = in_queue = begins
            doc = np.searchsorted(begins, x, side="right") - 1
            stretches.setdefault(q, []).append([docs[doc], x - begins[doc], in_queue, np.diff(np.append(x, end))])
        mine = {q: [np.concatenate(c) for c in zip(*parts, strict=True)] for q, parts in sorted(stretches.items())}
        queue = np.concatenate([np.full(len(c[0]), q) for q, c in mine.items()])
        low = np.concatenate([c[2] for c in mine.values()])
        seqs, counts = _windows(queue, low, low + np.concatenate([c[3] for c in mine.values()]), length, w, t, bend)
        before, after = counts[: len(seqs)], counts[len(seqs) :]
        inside = np.cumsum(after - before, axis=1) - (after - before)  # where each queue's turn begins
        cols: list[list[np.ndarray]] = []
        for q, (doc, into, place, size) in mine.items():
            by = np.argsort(place, kind="stable")
            doc, into, place, size = doc[by], into[by], place[by], size[by]
            cuts = np.unique(np.concatenate([place, before[:, q], after[:, q]]))
            of = np.searchsorted(place, cuts, side="right") - 1
            cuts, of = cuts[(of >= 0) & (cuts < place[of] + size[of])], of[(of >= 0) & (cuts < place[of] + size[of])]
            end = place[of] + size[of]
            end[:-1] = np.minimum(end[:-1], cuts[1:])
            seq = np.searchsorted(before[:, q], cuts, side="right") - 1
            cols.append([doc[of], into[of] + cuts - place[of], end - cuts, seqs[seq], inside[seq, q] + cuts - before[seq, q]])
        doc, start, size, seq, offset = (np.concatenate(c) for c in zip(*cols, strict=True))
        view = memoryview(ids).cast("B")
        at = first[doc] + start
        parts = [view[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), size.tolist(), strict=True)]
        names_ = pa.array(r["docs"], pa.int64())
        out = {
            "doc_id": names_.take(pa.array(doc)),
            "start": pa.array(start),
            "length": pa.array(size),
            "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            "doc_tokens": pa.array(sizes[doc]),
            "sequence_id": pa.array(seq),
            "offset": pa.array(offset),
        }
        if with_ids:
            out["ids"] = pa.array([p.tobytes() for p in parts], pa.binary())
        return pa.RecordBatch.from_pydict(out)

    return rows


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, target: dict[str, float] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and the ``ids``).

    ``target`` gives sources weights other than their token counts; those it leaves out share what is left of 1 by their
    token counts. When a source is empty, the others go on in their proportions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    chunks = written(rows.mapInArrow(_tokenized(tokenizer), _CHUNK), "tokens")
    per_source = written(chunks.select(F.inline("totals")).groupBy("source").agg(F.sum("tokens").alias("all")), "source-tokens")
    total = per_source.agg(F.sum("all")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], _PIECE + ", ids binary" * with_ids)
    if target is None:
        weighted = per_source.withColumn("weight", F.col("all").cast("double"))
        own = {r["source"]: (r["weight"], r["all"]) for r in weighted.where(F.col("all") >= total * OWN_QUEUE).collect()}  # 64 at most
        left = total - sum(n for _, n in own.values())
        common = [(float(left), left)] if left else []
    else:
        wanted = spark.createDataFrame([(s, max(float(w), 1e-9)) for s, w in target.items()], "source string, wanted double")
        weighted = per_source.join(wanted, "source", "left")
        known = {r["source"]: (r["wanted"], r["all"]) for r in weighted.where("wanted is not null").collect()}  # as many as the target has
        left, rest = total - sum(n for _, n in known.values()), max(1e-9, 1 - sum(target.values()))
        least = OWN_QUEUE * (sum(w for w, _ in known.values()) + (rest if left else 0))
        own = {s: x for s, x in known.items() if x[0] >= least}
        common = [x for s, x in known.items() if s not in own] + ([(rest, left)] if left else [])
        weighted = weighted.withColumn("weight", F.coalesce("wanted", F.lit(rest) * F.col("all") / F.lit(max(left, 1)))).drop("wanted")
    names = sorted(own)
    tokens = [own[s][1] for s in names] + [sum(n for _, n in common)]
    weights = [own[s][0] for s in names] + [sum(w for w, _ in common) or 1.0]
    # where each chunk's documents begin in their sources: sums over tasks, then over a task's chunks
    each = chunks.select("chunk", F.posexplode("totals").alias("at", "t")).select("chunk", F.shiftright("chunk", 32).alias("task"), "at", "t.source", "t.tokens")
    tasks = each.groupBy("source", "task").agg(F.sum("tokens").alias("sum"))
    tasks = tasks.withColumn("base", F.sum("sum").over(Window.partitionBy("source").orderBy("task")) - F.col("sum")).drop("sum")
    inner = F.sum("tokens").over(Window.partitionBy("source", "task").orderBy("chunk")) - F.col("tokens")
    starts = each.withColumn("inner", inner).join(tasks, ["source", "task"])
    starts = written(starts.select("chunk", "at", "source", "tokens", (F.col("base") + F.col("inner")).alias("start")), "starts")
    placed = chunks.join(starts.groupBy("chunk").agg(F.collect_list(F.struct("at", "start")).alias("starts")), "chunk")
    run = max(1, int(length * OWN_QUEUE))
    if common:
        small = starts.join(weighted.where(~F.col("source").isin(names)) if names else weighted, "source")
        runs = _runs(small, run, -(-tokens[-1] // SPAN))
        placed = placed.join(runs.groupBy("chunk").agg(F.collect_list(F.struct("at", "run", "place")).alias("runs")), "chunk", "left")
    else:
        placed = placed.withColumn("runs", F.lit(None))
    cut = _cut(names, weights, tokens, bend_of([w for w, _ in common], [n for _, n in common]), run, length, with_ids)
    # the order of fields is what to_pylist() hands over; nothing else depends on it
    return placed.mapInArrow(cut, _PIECE + ", ids binary" * with_ids)


def _runs(small: DataFrame, run: int, parts: int) -> DataFrame:
    """``chunk, at, run, place``: where in the common queue the runs begin that a chunk's tokens of a source are in.

    A run is due when a part of it is, which is the source's own part, so sources of few tokens are spread over the whole time.
    The chunk that has a run's first token counts it; others that have some of it sort behind.
    """
    numbers = F.explode(F.sequence(F.floor(F.col("start") / run), F.floor((F.col("start") + F.col("tokens") - 1) / run)))
    runs = small.select("chunk", "at", "source", "start", "all", "weight", numbers.alias("run"))
    phase = (F.pmod(F.xxhash64("source"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    runs = runs.withColumn("size", F.least(F.lit(run).cast("long"), F.col("all") - F.col("run") * run))
    due = 2 * (F.col("run") * run + phase * F.col("size")) / F.col("weight")
    runs = runs.select("chunk", "at", "source", "run", "size", due.alias("due"), (F.col("run") * run < F.col("start")).alias("later"))
    runs = written(runs.repartitionByRange(parts, "due", "source", "run").withColumn("part", F.spark_partition_id()), "runs")
    sums = runs.where("not later").groupBy("part").agg(F.sum("size").alias("sum"))
    bases = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("base"))  # a row for each task
    upto = Window.partitionBy("part").orderBy("due", "source", "run", "later").rowsBetween(Window.unboundedPreceding, 0)
    counted = F.sum(F.when(F.col("later"), 0).otherwise(F.col("size"))).over(upto)
    placed = runs.withColumn("upto", counted).join(bases, "part")
    return written(placed.select("chunk", "at", "run", (F.col("base") + F.col("upto") - F.col("size")).alias("place")), "places")
