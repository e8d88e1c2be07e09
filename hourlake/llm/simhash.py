"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are collapsed to distinct values first, so groups of copies cost one row. The 64 bits are then cut
into partitions of correlated bits, and each partition gets its own threshold: if the thresholds (plus
one each) add up to more than the wanted distance, two fingerprints within that distance must agree
within the threshold in some partition. Thresholds come from a dynamic program over the estimated
number of candidates, counted over all distinct fingerprints; they decide the cost, never the result.
Each fingerprint is filed under its exact value in every partition and probes the values within that partition's
threshold. The task that owns a value verifies all candidates exactly and reports only a spanning
forest of the links it finds, so a bucket of n near copies gives n - 1 links, not n². Buckets beyond
``BUCKET`` rows are dealt anew by five blocks of all bits, and what is still larger by pieces of its filed and
its asking rows, which loses no link and leaves no task more than twice ``BUCKET`` rows of a bucket.

Texts that are null or have no word have fingerprint zero and are linked like any other. Rows with a null
id are documents too, but a component is named by the least id that is not null (null only if no member has
one). Repeated rows share a fingerprint. Extra columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hourlake.llm.common import NO_ID, keyed, longs, record, signed, text_list, unsigned, with_key
from hourlake.llm.components import components
from hourlake.sources.scratch import written

BITS = 64
#: Rows of one probed value that a single task compares; larger buckets are dealt anew.
BUCKET = 4096
_SEED = 42


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, lower-cased (A-Z) and joined by one space."""
    words = text.lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), _SEED)]
    flat = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [digest(flat[a:b], _SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        block = np.ascontiguousarray(hashes[i : i + (1 << 14)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprinted(size: int):
    schema = pa.schema([("_id", pa.int64()), ("_row", pa.int64()), ("fp", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([majority(np.array(shingle_hashes(t, size), dtype=np.uint64)) for t in text_list(batch)], dtype=np.uint64)
            yield record(schema, batch.column(0), batch.column(1), signed(fps))

    return rows


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``_id, _row, fp`` of every document."""
    return keyed(docs).select("_id", "_row", "text").mapInArrow(_fingerprinted(size), "_id long, _row long, fp long")


# ---------------------------------------------------------------- the plan: partitions and thresholds


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits that are set together, over all rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = unsigned(batch.column(0))
            for i in range(0, len(values), 1 << 15):
                bits = np.unpackbits(np.ascontiguousarray(values[i : i + (1 << 15)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
            n += len(values)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(BITS * BITS + 1), pa.int32()), "n": longs(np.append(total.ravel(), n))})

    rows = fps.select("fp").mapInArrow(sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect()
    counts = np.array([r["n"] for r in rows], dtype=np.float64) if rows else np.zeros(BITS * BITS + 1)
    return int(counts[-1]), counts[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of equal size; each next bit of a group is the one most correlated with it."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: corr[b, free].sum())]
        free.remove(group[0])
        while len(group) < width:
            group.append(max(free, key=lambda b: corr[b, group].sum()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def part_value(bits: list[int], fp: Column | None = None) -> Column:
    """A fingerprint reduced to some of its bits (which stay in their places)."""
    return (F.col("fp") if fp is None else fp).bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def equal_pairs(fps: DataFrame, groups: list[list[int]]) -> list[float]:
    """For each group of bits: how many pairs (ordered, own included) agree in it, over all fingerprints."""
    each = fps.select(F.posexplode(F.array(*[part_value(g) for g in groups])).alias("part", "v"))
    counted = each.groupBy("part", "v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    got = {r["part"]: r["pairs"] for r in counted.groupBy("part").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()}
    return [got.get(i, 0.0) for i in range(len(groups))]


def _ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def allocate(n: int, widths: list[int], pairs: list[float], distance: int) -> tuple[float, list[int]]:
    """Cost and thresholds (-1: partition not probed) with ``sum(t + 1) == distance + 1``, by dynamic programming.

    A partition with threshold t costs its probes and its candidates; these are at most the ball's size times the
    pairs that agree exactly (Cauchy-Schwarz), which is the estimate.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, equal in zip(widths, pairs, strict=True):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, min(width, distance - used) + 1):
                more = cost + (_ball(width, t) * (8.0 * n + equal) if t >= 0 else 0.0)
                if used + t + 1 not in step or more < step[used + t + 1][0]:
                    step[used + t + 1] = (more, [*chosen, t])
        best = step
    return best[distance + 1]


def plan(fps: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """The cheapest of several numbers of partitions: groups of bits with their thresholds."""
    n, together = bit_statistics(fps)
    choices = [correlated_groups(n, together, k) for k in range(2, distance + 2)] or [[list(range(BITS))]]
    flat = [g for c in choices for g in c]
    pairs, best = iter(equal_pairs(fps, flat)), None
    for groups in choices:
        cost, thresholds = allocate(n, [len(g) for g in groups], [next(pairs) for _ in groups], distance)
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, thresholds, strict=True)))
    return best[1]


# ---------------------------------------------------------------- probing and verifying


def _masks(bits: list[int], radius: int) -> list[int]:
    """All changes of 1 to ``radius`` of the bits."""
    return [_signed(sum(1 << b for b in some)) for r in range(1, radius + 1) for some in combinations(bits, r)]


def probes(fps: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """``part, v, fp, filed``: each fingerprint under its own value (filed) and under all values within the threshold."""
    sides = []
    for i, (bits, t) in enumerate(chosen):
        if t < 0:
            continue
        own = fps.select(F.lit(i).alias("part"), part_value(bits).alias("v"), "fp")
        sides.append(own.withColumn("filed", F.lit(True)))
        if t:
            near = F.explode(F.transform(F.array(*[F.lit(m) for m in _masks(bits, t)]), lambda m: F.col("v").bitwiseXOR(m)))
            sides.append(own.select("part", near.alias("v"), "fp", F.lit(False).alias("filed")))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out


def _forest(filed: np.ndarray, asking: np.ndarray, distance: int) -> np.ndarray:
    """Links of a spanning forest: pairs within the distance of which at least one is filed here."""
    everyone = np.concatenate([filed, asking])
    root = np.arange(len(everyone))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    step = max(1, (1 << 20) // max(1, len(everyone)))
    for i in range(0, len(filed), step):
        near = np.bitwise_count(filed[i : i + step, None] ^ everyone[None, :]) <= distance
        a, b = np.nonzero(near)
        a += i
        for x, y in zip(a[a < b].tolist(), b[a < b].tolist(), strict=True):
            rx, ry = find(x), find(y)
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                out.append((everyone[x], everyone[y]))
    return np.array(out, dtype=np.uint64).reshape(-1, 2)


_LINKS = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _verify(distance: int):
    """Rows come sorted by bucket; buckets are taken from the stream one by one (a small one costs no numpy call)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
            keys, n = cols[:-2], len(cols[0])
            new = np.zeros(n, dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            edges = np.concatenate([[0], np.flatnonzero(new)])
            rest = [c[edges[-1] :] for c in cols]  # the last bucket may go on in the next batch
            yield from _buckets(cols[-2], cols[-1], edges)
        if rest is not None and len(rest[0]):
            yield from _buckets(rest[-2], rest[-1], np.array([0, len(rest[0])]))

    def _buckets(fp: np.ndarray, filed: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, filed = fp.view(np.uint64), filed.astype(bool)
        size = np.diff(edges)
        # a bucket matters if it has two rows, one of them filed
        held = np.add.reduceat(filed.astype(np.int64), edges[:-1]) if len(size) else np.zeros(0, np.int64)
        found = []
        pairs = np.flatnonzero((size == 2) & (held > 0))
        x, y = fp[edges[pairs]], fp[edges[pairs] + 1]
        ok = (np.bitwise_count(x ^ y) <= distance) & (x != y)
        found.append(np.stack([x[ok], y[ok]], axis=1))
        for k in np.flatnonzero((size > 2) & (held > 0)):
            s = slice(edges[k], edges[k + 1])
            if np.array_equal(fp[s].min(), fp[s].max()):
                continue
            found.append(_forest(np.unique(fp[s][filed[s]]), np.setdiff1d(fp[s][~filed[s]], fp[s][filed[s]]), distance))
        got = np.concatenate(found)
        if len(got):
            yield record(_LINKS, signed(got[:, 0]), signed(got[:, 1]))

    return links


def links_within(fps: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """Distinct ``x, y``: links that connect all fingerprints that are at most ``distance`` bits apart, in chains.

    ``fps`` has distinct fingerprints ``fp``; it is read several times, so it should be a written table.
    """
    chosen = plan(fps, distance)
    rows = probes(fps, chosen)
    heavy = rows.groupBy("part", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select("part", "v", F.lit(True).alias("heavy"))
    marked = written(rows.join(heavy, ["part", "v"], "left"), "probes")
    light = marked.where("heavy is null").repartition("part", "v").sortWithinPartitions("part", "v").select("part", "v", "fp", "filed")
    found = light.mapInArrow(_verify(distance), "x long, y long")
    # a heavy value: any two of its rows within the distance agree in one of distance + 1 blocks of all bits
    blocks = [list(range(k, BITS, distance + 1)) for k in range(distance + 1)]
    again = marked.where("heavy").select("part", "v", F.posexplode(F.array(*[part_value(b) for b in blocks])).alias("block", "w"), "fp", "filed")
    return found.unionByName(_pieces(again, bucket).mapInArrow(_verify(distance), "x long, y long")).distinct()


def _pieces(rows: DataFrame, bucket: int) -> DataFrame:
    """Buckets ``part, v, block, w`` in pieces of bounded size, sorted; every filed row meets every other row in one of them.

    A bucket of k times ``bucket`` rows becomes k x k pieces: filed rows of one k-th with asking rows of another.
    """
    keys = ["part", "v", "block", "w"]
    rows = rows.join(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / bucket).cast("int").alias("k")), keys)
    own, every = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"), F.sequence(F.lit(0), F.col("k") - 1)
    whole = rows.where("k = 1").select(*keys, F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "filed")
    split = rows.where("k > 1")
    filed = split.where("filed").select(*keys, own.alias("i"), F.explode(every).alias("j"), "fp", "filed")
    asks = split.select(*keys, F.explode(every).alias("i"), own.alias("j"), "fp", F.lit(False).alias("filed"))
    at = [*keys, "i", "j"]
    return whole.unionByName(filed).unionByName(asks).repartition(*at).sortWithinPartitions(*at)


# ---------------------------------------------------------------- the operator


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """``_id, _row, fp, root, component``: the component's own name, and the least id that is not null in it (null if there is none)."""
    rows = written(fingerprints(docs, size), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min(_null_id("_id")).alias("least")), "classes")
    links = links_within(classes.select("fp"), distance)
    # components over fingerprints, then the least id of each
    found = written(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))), "components")
    classes = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp")).drop("component")
    least = classes.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(classes.select("fp", "root").join(least, "root"), "fp")


def _null_id(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def simhash_components(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    return near_duplicates(docs, size, distance).select(
        _null_id("_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


def first_of_each(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the least id, and of these the least text hash.

    A document without an id stays only where no member has one. Of identical rows one stays.
    """
    first = F.min(F.struct((F.col("_id") == NO_ID).alias("none"), "_id", "_row"))
    picked = near_duplicates(docs, size, distance).groupBy("root").agg(first.alias("p"))
    kept = with_key(docs).join(picked.select(F.struct("p._id", "p._row").alias("_key")), "_key", "left_semi")
    again = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return kept.withColumn("_copy", again).where("_copy = 1").select("_doc.*")
