"""Heavy keys: finding them, splitting them.

A plan that puts all rows of a key into one task stops scaling as soon as one key holds a large part
of the data. Two remedies, both exact:

* *salting* for joins: rows of a heavy key are spread over several groups and the other side's rows
  for that key are copied to each of them;
* *spans* for ordered windows: a heavy key is cut into time ranges holding about equally many rows;
  what an earlier (later) range would contribute to the window is carried over as one row per range.

Heavy keys and their cuts stay in tables; only whether there is any, and the size of the largest,
reach the driver. There are at most ``rows / heavy_rows`` of them and about as many cuts, and every
one of them is split: what is left in one task is about ``heavy_rows`` rows whatever the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from hourlake.functions.time import micros
from hourlake.sources.scratch import written

#: A key with fewer rows than this fits one task and is never split.
HEAVY_ROWS = 5_000_000
#: Groups over which rows without a key are spread.
NULL_PIECES = 512
#: Relative precision of the quantile sketch: cuts finer than this can't be told apart.
RESOLUTION = 1 << 16


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame | None:
    """``keys`` and row count ``_n`` of every key with at least ``heavy_rows`` rows, or None.

    One aggregate over the key columns, counted map-side; the few heavy keys are written to scratch.
    """
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_n"))
    found = written(counts.filter(F.col("_n") >= heavy_rows), "heavy-keys")
    return None if found.isEmpty() else found


def spread_nulls(keys: Sequence[str], by: Sequence[str], pieces: int = NULL_PIECES) -> Column:
    """0 for rows with a full key, otherwise 1..pieces: NULL keys must not meet in one task."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return F.when(any_null, F.pmod(F.xxhash64(*by), F.lit(pieces)) + 1).otherwise(F.lit(0)).cast("int")


def zero(keys: Sequence[str]) -> Column:
    """0, written so that the optimizer cannot fold it: it has to stay an equi-join key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    heavy_rows: int = HEAVY_ROWS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Equi join where ``left`` may have heavy keys and ``right`` has few rows per key.

    ``how`` is inner, left, left_semi or left_anti. Rows of a heavy key are dealt out over about
    ``count / heavy_rows`` groups and only the heavy keys' right rows are copied.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if heavy is None:
        heavy = heavy_keys(left, keys, heavy_rows)
    null_piece = spread_nulls(keys, left.columns)
    if heavy is None:
        l = left.withColumn("_salt", null_piece)
        r = right.withColumn("_salt", zero(keys))
        return l.join(r, [*keys, "_salt"], how).drop("_salt")
    # A written table, so Spark knows its size and copies it to all executors only if it is small.
    hot = heavy.select(*keys, F.ceil(F.col("_n") / F.lit(heavy_rows)).cast("int").alias("_pieces"))
    l = left.join(hot, list(keys), "left").withColumn(
        "_salt",
        F.when(F.col("_pieces").isNull(), null_piece)
        .otherwise(F.pmod(F.xxhash64(*left.columns), F.col("_pieces")))
        .cast("int"),
    )
    r = right.join(hot, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    joined = l.drop("_pieces").join(r.drop("_pieces"), [*keys, "_salt"], how)
    return joined.drop("_salt")


@dataclass(frozen=True)
class Spans:
    """Time cuts (microseconds) of the heavy keys: ``frame(key…, _cuts array<bigint>)``."""

    keys: tuple[str, ...]
    frame: DataFrame

    def assign(self, df: DataFrame, at: str, spread_ties_by: Sequence[str] = ()) -> DataFrame:
        """Add ``_span``: 0 for ordinary keys, else the number of cuts not after ``at``.

        Equal cuts mean that one instant alone fills several spans. Rows at exactly that instant go
        to its first span, or are dealt out over all of them by a hash of ``spread_ties_by``.
        """
        t = micros(at)
        below = F.size(F.filter("_cuts", lambda c: c < t))
        upto = F.size(F.filter("_cuts", lambda c: c <= t))
        first = F.least(below + 1, upto)
        if spread_ties_by:
            ties = F.greatest(upto - below, F.lit(1))
            span = first + F.pmod(F.xxhash64(*spread_ties_by), ties).cast("int")
        else:
            span = first
        joined = df.join(self.frame, list(self.keys), "left")
        return joined.withColumn(
            "_span", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(span).cast("int")
        ).drop("_cuts")

    def _grid(self) -> DataFrame:
        return self.frame.select(
            *self.keys, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_span")
        )

    def carry(self, rows: DataFrame, value: Column, order: Column, forward: bool = True) -> DataFrame:
        """``(key…, _span, _carry)``: the last value before (or first value after) each span.

        One row per span of a heavy key.
        """
        pick = F.max_by if forward else F.min_by
        per_span = (
            rows.join(self.frame.select(*self.keys), list(self.keys), "left_semi")
            .groupBy(*self.keys, "_span")
            .agg(pick(value, order).alias("_v"))
        )
        w = Window.partitionBy(*self.keys).orderBy("_span")
        if forward:
            got = F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        else:
            got = F.first("_v", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
        filled = self._grid().join(per_span, [*self.keys, "_span"], "left")
        return filled.select(*self.keys, "_span", got.alias("_carry"))


def find_spans(
    rows: DataFrame, keys: Sequence[str], at: str, heavy_rows: int = HEAVY_ROWS
) -> Spans | None:
    """Cut every heavy key of ``rows`` into time ranges of about ``heavy_rows`` rows; None if none.

    Cuts come from a quantile sketch (merged map-side) as fine as the largest key needs; they only
    steer the split, results do not depend on where they fall. They are written once, so that every
    use sees the same cuts.
    """
    hot = heavy_keys(rows, keys, heavy_rows)
    if hot is None:
        return None
    most = min(RESOLUTION, max(2, -(-hot.agg(F.max("_n")).first()[0] // heavy_rows)))
    grid = [i / most for i in range(1, most)]
    sketched = (
        rows.select(*keys, micros(at).alias("_t"))
        .join(hot, list(keys))
        .groupBy(*keys)
        .agg(F.first("_n").alias("_n"), F.percentile_approx("_t", grid, max(10_000, 4 * most)).alias("_q"))
    )
    pieces = F.least(F.greatest(F.ceil(F.col("_n") / heavy_rows), F.lit(2)), F.lit(most)).cast("int")
    cut = lambda i: F.element_at("_q", F.greatest(F.round(i * most / pieces), F.lit(1)).cast("int"))
    cuts = F.transform(F.sequence(F.lit(1), pieces - 1), cut)
    return Spans(tuple(keys), written(sketched.select(*keys, cuts.alias("_cuts")), "cuts"))
