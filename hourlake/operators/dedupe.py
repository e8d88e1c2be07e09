"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order`` values per key; ties go to ``tiebreak``.

    The input is read once and shuffled once. It is a window cut at its first row, which Spark also cuts *before* the
    shuffle: every task keeps one row of a key, so a key that holds a third of the table sends one row per
    task over the network. With ``tiebreak=None`` all remaining columns break ties, which makes the
    result deterministic; columns that are neither in ``order`` nor in ``tiebreak`` come last.
    """
    rest = [c for c in df.columns if c not in keys]
    if tiebreak is None:
        tiebreak = [c for c in rest if c not in order]
    if not rest:
        return df.select(*keys).distinct()
    lead = list(dict.fromkeys([*order, *tiebreak]))
    latest_first = [F.col(c).desc_nulls_last() for c in [*lead, *[c for c in rest if c not in lead]]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    return df.select("*", place.alias("_place")).filter("_place = 1").drop("_place")


def latest_value(df: DataFrame, keys: Sequence[str], value: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``keys`` and the ``value`` columns of the latest row per key."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*value), F.struct(*order_cols)).alias("_v")
    )
    return picked.select(*keys, *[F.col(f"_v.{c}") for c in value])
