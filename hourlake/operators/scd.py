"""Slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from hourlake.functions.time import ntz
from hourlake.operators.dedupe import latest_per_key
from hourlake.operators.skew import HEAVY_ROWS, find_spans


def _differs(a: str, b: str, cols: Sequence[str]) -> Column:
    """True when any column differs, counting NULL as an ordinary value."""
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return changed


def scd2_snapshot(
    current: DataFrame, history: DataFrame, key: str, check_cols: Sequence[str], as_of: datetime
) -> DataFrame:
    """Next state of a type-2 history after comparing it with the ``current`` rows (one per key).

    New keys are opened at ``as_of``; a key whose ``check_cols`` changed is closed and reopened at
    ``as_of``; unchanged keys, and keys missing from ``current``, stay as they are. Columns:
    those of ``current`` plus ``valid_from`` and ``valid_to``.
    """
    cols = current.columns
    # Closed rows fail the join condition and so pass through a single full outer join untouched.
    h = history.select(F.struct(*cols, "valid_from", "valid_to").alias("h"))
    n = current.select(F.struct(*cols).alias("n"))
    on = (F.col(f"h.{key}") == F.col(f"n.{key}")) & F.col("h.valid_to").isNull()
    both = h.join(n, on, "full_outer")

    now = ntz(as_of)
    changed = F.col("h").isNotNull() & F.col("n").isNotNull() & _differs("h", "n", check_cols)
    kept = F.when(
        F.col("h").isNotNull(),
        F.col("h").withField("valid_to", F.when(changed, now).otherwise(F.col("h.valid_to"))),
    )
    opened = F.when(
        F.col("h").isNull() | changed,
        F.struct(
            *[F.col(f"n.{c}").alias(c) for c in cols],
            now.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        ),
    )
    rows = both.select(F.explode(F.array(kept, opened)).alias("r")).filter(F.col("r").isNotNull())
    return rows.select("r.*")


def scd2_from_history(
    obs: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Type-2 versions built from observations over time: ``key, other columns, valid_from, valid_to``.

    A version starts at the first observation and whenever a ``check_cols`` value differs from the
    preceding observation; it ends where the next one starts. Of several observations of a key at
    the same instant the last by ``tiebreak`` (then by the remaining columns) counts. Rows without a
    key or time are ignored. Validity follows event time, so rebuilding from late data splits versions
    correctly.
    """
    obs = obs.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rest = [c for c in obs.columns if c not in (key, ts)]
    by = Window.partitionBy(key, "_span")
    # One instant is sorted by the tie-breakers and its last row counts; the same sort serves all
    # windows below, so ordinary keys need a single shuffle.
    full = by.orderBy(ts, *tiebreak, *[c for c in rest if c not in tiebreak])
    w = by.orderBy(ts)
    spans = find_spans(obs, [key], ts, heavy_rows)
    if spans is None:
        rows = obs.withColumn("_span", F.lit(0))
    else:
        # With heavy keys, one instant of one key may be huge: reduce it before the shuffle.
        rows = spans.assign(latest_per_key(obs, [key, ts], list(tiebreak)), ts)
    rows = rows.withColumn("_after", F.lead(ts).over(full))
    rows = rows.filter(~F.col("_after").eqNullSafe(F.col(ts))).drop("_after")
    rows = rows.withColumn("_now", F.struct(*check_cols))

    rows = rows.withColumn("_prev", F.lag("_now").over(w))
    if spans is not None:
        rows = _fill(rows, spans.carry(rows, F.col("_now"), F.col(ts)), key, "_prev")
    starts = rows.filter(F.col("_prev").isNull() | _differs("_prev", "_now", check_cols))
    starts = starts.withColumn("valid_to", F.lead(ts).over(w))
    if spans is not None:
        starts = _fill(
            starts, spans.carry(starts, F.col(ts), F.col(ts), forward=False), key, "valid_to"
        )
    return starts.select(key, *rest, F.col(ts).alias("valid_from"), "valid_to")


def _fill(rows: DataFrame, carried: DataFrame, key: str, target: str) -> DataFrame:
    return (
        rows.join(carried, [key, "_span"], "left")
        .withColumn(target, F.coalesce(F.col(target), F.col("_carry")))
        .drop("_carry")
    )


def scd1_upsert(dim: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Type-1 dimension after applying ``latest`` (one row per key): newest wins, nothing vanishes."""
    cols = dim.columns
    d = dim.select(F.struct(*cols).alias("d"))
    n = latest.select(F.struct(*cols).alias("n"))
    both = d.join(n, F.col(f"d.{key}") == F.col(f"n.{key}"), "full_outer")
    return both.select(F.coalesce("n", "d").alias("r")).select("r.*")
