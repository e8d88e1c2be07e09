"""Centroid clustering of embeddings over subvector dictionaries, in exact integer arithmetic.

Vectors are dictionary-encoded once, without loss: a *page* holds up to ``PAGE`` vectors; in it the dimensions are cut
into blocks, each block has a dictionary of its distinct subvectors, and a vector is a row of codes. Pages are written
to shared scratch; a lost executor costs the page it worked on. A round then never touches a vector's components:

* the squared distance of every dictionary entry to every centroid is computed once for the round and page;
* a vector's distance is the sum of its codes' partial distances;
* new centroids come from counts: how often a cluster uses each code, times the dictionary.

Dictionaries belong to pages and not to the table, so that they are bounded, need neither a broadcast nor a join of every
vector with every block, and no vector ever crosses the network: a round shuffles ``centroids x dimensions`` sums
for each task. The block width is chosen for each page: the one of ``WIDTHS`` with the fewest
operations, so copies of a vector collapse into one wide entry and values that differ into narrow ones.

Only the centroids (``k x dims`` integers) reach the driver and the tasks. Seeds come from a top-k over hashes.

Defined results: vectors that are null, of another length, or with a null or non-finite component are left out. Rows with
an equal id are separate vectors. Ties of seeds are broken by the components, rows without an id come last among
seeds. With fewer vectors than ``k`` there are as many clusters as vectors; no vector, no row. Components are limited
to 2^62 and distances to the greatest long, beyond which the result types can't go. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourlake.llm.common import longs, record
from hourlake.sources.scratch import written

#: Vectors of one page.
PAGE = 1 << 14
#: Widths of blocks that a page may choose from.
WIDTHS = (64, 16, 4, 1)
#: Components are limited to this; squares of smaller differences than ``SAFE`` add up in a long for 64 dimensions.
LIMIT = 1 << 62
SAFE = 1 << 28
_TOP = (1 << 63) - 1
_HALF = 31


# ---------------------------------------------------------------- vectors and pages


def whole_vectors(embeddings: DataFrame, dims: int) -> DataFrame:
    """``vec_id, x`` (array of doubles): the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return embeddings.where((F.size(x) == dims) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, limited to what long arithmetic can hold."""
    return np.clip(np.floor(scale * x), -float(LIMIT), float(LIMIT)).astype(np.int64)


def encode(vectors: np.ndarray) -> tuple[int, list[np.ndarray], np.ndarray]:
    """Block width, a dictionary (entries x width) for each block, and the codes (vectors x blocks)."""
    n, dims = vectors.shape
    best = None
    for width in WIDTHS:
        if dims % width:
            continue
        found = [_distinct(vectors[:, i : i + width]) for i in range(0, dims, width)]
        cost = sum(d.size for d, _ in found) + n * len(found)
        if best is None or cost < best[0]:
            best = (cost, width, found)
    _, width, found = best
    return width, [d for d, _ in found], np.stack([c for _, c in found], axis=1)


def _distinct(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and every row's place among them."""
    if block.shape[1] == 1:
        entries, codes = np.unique(block[:, 0], return_inverse=True)
        return entries[:, None], codes
    rows = np.ascontiguousarray(block).view(np.dtype((np.void, block.shape[1] * 8)))[:, 0]
    _, first, codes = np.unique(rows, return_index=True, return_inverse=True)
    return block[first], codes


_PAGE = pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("width", pa.int64()), ("sizes", pa.binary()), ("entries", pa.binary()), ("codes", pa.binary())])
_PAGE_DDL = "n long, ids binary, known binary, width long, sizes binary, entries binary, codes binary"


def _pages(dims: int, scale: int):
    def page(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        width, dictionaries, codes = encode(integers(x, scale))
        sizes = np.array([len(d) for d in dictionaries], dtype=np.int64)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        small = np.uint16 if sizes.max() <= 1 << 16 else np.uint32
        parts = (ids.fill_null(0).to_numpy().astype(np.int64), known, sizes, np.concatenate([d.ravel() for d in dictionaries]), codes.astype(small))
        raw = [p.tobytes() for p in parts]
        return record(_PAGE, longs([len(x)]), *[pa.array([b], pa.binary()) for b in raw[:2]], longs([width]), *[pa.array([b], pa.binary()) for b in raw[2:]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held, n = [], [], 0
        for batch in batches:
            ids, x = batch.column(0), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for i in range(0, len(x), PAGE):
                held_ids.append(ids[i : i + PAGE])
                held.append(x[i : i + PAGE])
                n += len(held[-1])
                if n >= PAGE:
                    yield page(pa.concat_arrays(held_ids), np.concatenate(held))
                    held_ids, held, n = [], [], 0
        if n:
            yield page(pa.concat_arrays(held_ids), np.concatenate(held))

    return rows


class Page:
    """An encoded page as a task reads it."""

    def __init__(self, row: dict):
        self.n, self.width = row["n"], row["width"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        sizes = np.frombuffer(row["sizes"], np.int64)
        ends = np.cumsum(sizes * self.width)
        flat = np.frombuffer(row["entries"], np.int64)
        self.dictionaries = [flat[e - s * self.width : e].reshape(-1, self.width) for e, s in zip(ends, sizes, strict=True)]
        small = np.uint16 if sizes.max() <= 1 << 16 else np.uint32
        self.codes = np.frombuffer(row["codes"], small).reshape(self.n, len(sizes))

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances (vectors x centroids): partial distances of the dictionaries, summed by code."""
        total = np.zeros((self.n, len(centroids)), dtype=np.int64)
        rough = np.zeros(total.shape) if self._wide(centroids) else None
        for b, entries in enumerate(self.dictionaries):
            at = centroids[:, b * self.width : (b + 1) * self.width]
            partial = np.empty((len(entries), len(at)), dtype=np.int64)
            estimate = np.empty(partial.shape)
            for k, c in enumerate(at):
                apart = entries - c
                partial[:, k] = np.einsum("ij,ij->i", apart, apart)
                if rough is not None:
                    apart = entries.astype(np.float64) - c
                    estimate[:, k] = np.einsum("ij,ij->i", apart, apart)
            total += partial[self.codes[:, b]]
            if rough is not None:
                rough += estimate[self.codes[:, b]]
        if rough is not None:  # sums wrap around, which is exact where the true sum is a long
            total[rough >= float(1 << 63) * (1 - 1e-12)] = _TOP
        return total

    def _wide(self, centroids: np.ndarray) -> bool:
        ends = [f(x) for x in (*self.dictionaries, centroids) for f in (np.min, np.max)]
        return int(max(ends)) - int(min(ends)) >= SAFE

    def sums(self, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of each cluster, and its component sums as two halves (high, low 31 bits), so that no sum overflows."""
        high, low = [], []
        for b, entries in enumerate(self.dictionaries):
            used = np.bincount(cluster * len(entries) + self.codes[:, b], minlength=k * len(entries)).reshape(k, len(entries))
            high.append(used @ (entries >> _HALF))
            low.append(used @ (entries & ((1 << _HALF) - 1)))
        return np.bincount(cluster, minlength=k), np.concatenate(high, axis=1), np.concatenate(low, axis=1)


def pages(embeddings: DataFrame, dims: int = 64, scale: int = 1024) -> DataFrame:
    """The table of encoded pages, written to scratch."""
    return written(whole_vectors(embeddings, dims).mapInArrow(_pages(dims, scale), _PAGE_DDL), "pages")


# ---------------------------------------------------------------- seeds and rounds


def seeds(embeddings: DataFrame, k: int, dims: int = 64, scale: int = 1024, seed: int = 3) -> np.ndarray:
    """The vectors with the ``k`` least SHA-256 of ``<seed>:<vec_id>``, in that order (a top-k, never a full sort)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = whole_vectors(embeddings, dims).orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()
    return integers(np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), dims), scale)


_SUMS = pa.schema([("cluster", pa.int64()), ("dim", pa.int64()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])


def _round(centroids: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        n, high, low = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                page = Page(batch.slice(i, 1).to_pylist()[0])
                more = page.sums(page.distances(centroids).argmin(axis=1), k)
                n, high, low = n + more[0], high + more[1], low + more[2]
        yield record(_SUMS, longs(np.repeat(np.arange(k), dims)), longs(np.tile(np.arange(dims), k)), longs(np.repeat(n, dims)), longs(high.ravel()), longs(low.ravel()))

    return rows


def next_centroids(encoded: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: componentwise ``floor(sum / count)`` of every cluster that has vectors; the others stay."""
    each = encoded.mapInArrow(_round(centroids), "cluster long, dim long, n long, high long, low long").where("n > 0")
    out = centroids.copy()
    for r in each.groupBy("cluster", "dim").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]).collect():  # k x dims rows
        out[r["cluster"], r["dim"]] = ((int(r["high"]) << _HALF) + int(r["low"])) // int(r["n"])
    return out


_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assign(centroids: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                page = Page(batch.slice(i, 1).to_pylist()[0])
                d = page.distances(centroids)
                cluster = d.argmin(axis=1)
                yield record(_ASSIGNED, pa.array(page.ids, mask=~page.known), pa.array(cluster.astype(np.int32)), longs(d[np.arange(len(d)), cluster]))

    return rows


def centroid_text(centroid: np.ndarray) -> str:
    return ",".join(map(str, centroid.tolist()))


def cluster(embeddings: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every vector that takes part, and the final centroids."""
    encoded, centroids = pages(embeddings, dims, scale), seeds(embeddings, k, dims, scale, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        moved = next_centroids(encoded, centroids)
        if np.array_equal(moved, centroids):  # nothing moves any more: further rounds would repeat this one
            break
        centroids = moved
    return encoded.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), centroids


def clustered(embeddings: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """``cluster`` with ``cluster_inertia``, ``inertia`` (limited to the greatest long) and ``centroid_sha256``."""
    found, centroids = cluster(embeddings, k, rounds, dims, scale, seed)
    found = written(found, "assigned")
    # one row per cluster, joined back as literals
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    within = lambda v: F.lit(min(v, _TOP)).cast("long")
    own, sha = F.lit(None).cast("long"), F.lit(None).cast("string")
    for c, s in sums.items():
        own = F.when(F.col("cluster") == c, within(s)).otherwise(own)
        sha = F.when(F.col("cluster") == c, F.lit(hashlib.sha256(centroid_text(centroids[c]).encode()).hexdigest())).otherwise(sha)
    return found.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"), within(sum(sums.values())).alias("inertia"), sha.alias("centroid_sha256"))
