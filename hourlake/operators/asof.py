"""Point-in-time join: for every fact row the dimension version valid when it happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hourlake.functions.time import FAR_FUTURE, ntz
from hourlake.operators.skew import HEAVY_ROWS, NULL_PIECES, find_spans, spread_nulls, zero

#: Up to this many versions per entity, comparing a fact row with all of them is cheaper than sorting.
#: Only the plan depends on it.
FEW_VERSIONS = 32


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    strategy: str = "auto",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``fact`` plus the columns of the ``dim`` version with ``valid_from <= ts < valid_to``.

    ``valid_to`` NULL means still valid. Rows without a version (or with a NULL key) are kept with
    NULLs for ``how='left'`` and dropped for ``how='inner'``. Where versions overlap, the one that
    started last decides (ties: by a hash of the version): a row never meets two versions. Two
    strategies, same result:

    * ``range`` - equi join with a range residual: every fact row meets every version of its entity.
      Best when entities have few versions: a small dimension is broadcast by Spark after its own
      size check and the fact is not shuffled; beyond that it is a sort-merge join whose heavy fact
      keys the adaptive skew join splits.
    * ``window`` - versions are merged into the fact's time order and the last one is carried
      forward: one shuffle and one sort, linear in rows however many versions an entity has. Heavy
      keys are cut into time spans, so no key has to fit one task.

    ``auto`` counts versions (an aggregate over the dimension) and takes ``range`` if no entity has
    more than ``FEW_VERSIONS``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    if strategy == "auto":
        strategy = "range" if _most_versions(dim, key) <= FEW_VERSIONS else "window"
    if strategy == "range":
        return _range(fact, dim, key, ts, valid_from, valid_to, how)
    if strategy == "window":
        return _window(fact, dim, key, ts, valid_from, valid_to, how, heavy_rows)
    raise ValueError(f"unknown strategy {strategy!r}")


def _most_versions(dim: DataFrame, key: str) -> int:
    counts = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _open_end(c):
    return F.coalesce(c, ntz(FAR_FUTURE))


def _live(dim, key, valid_from, valid_to):
    """Versions of an entity that were ever valid: others must not hide a neighbour."""
    return dim.filter(F.col(key).isNotNull() & (F.col(valid_from) < _open_end(F.col(valid_to))))


def _range(fact, dim, key, ts, valid_from, valid_to, how):
    f = fact.withColumn("_piece", spread_nulls([key], fact.columns))
    # The next version ends this one, if it has not ended before.
    starts = Window.partitionBy(key).orderBy(valid_from, F.xxhash64(*dim.columns))
    d = _live(dim, key, valid_from, valid_to).withColumn(
        "_until", F.least(_open_end(F.col(valid_to)), F.lead(valid_from).over(starts))
    )
    d = d.withColumnRenamed(key, "_dim_key").withColumn("_dim_piece", zero(["_dim_key"]))
    on = (
        (F.col(key) == F.col("_dim_key"))
        & (F.col("_piece") == F.col("_dim_piece"))
        & (F.col(ts) >= F.col(valid_from))
        & (F.col(ts) < F.col("_until"))
    )
    return f.join(d, on, how).drop("_piece", "_dim_key", "_dim_piece", "_until")


def _window(fact, dim, key, ts, valid_from, valid_to, how, heavy_rows):
    dim_cols = [c for c in dim.columns if c != key]
    version = F.struct(*[F.col(c) for c in dim_cols])
    d = _live(dim, key, valid_from, valid_to).select(
        F.col(key),
        F.col(valid_from).alias("_at"),
        F.lit(0).alias("_kind"),
        F.xxhash64(*dim.columns).alias("_tie"),
        version.alias("_ver"),
    )
    f = fact.withColumn("_at", F.col(ts)).withColumn("_kind", F.lit(1))

    spans = find_spans(f.select(key, "_at").unionByName(d.select(key, "_at")), [key], "_at", heavy_rows)
    if spans is None:
        f, d = f.withColumn("_span", F.lit(0)), d.withColumn("_span", F.lit(0))
    else:
        f, d = spans.assign(f, "_at", spread_ties_by=fact.columns), spans.assign(d, "_at")
    null_piece = F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_PIECES)).cast("int")
    f = f.withColumn("_span", F.when(F.col(key).isNull(), null_piece).otherwise(F.col("_span")))

    merged = f.unionByName(d, allowMissingColumns=True)
    w = Window.partitionBy(key, "_span").orderBy("_at", "_kind", "_tie")
    seen = F.last("_ver", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = merged.withColumn("_seen", seen).filter(F.col("_kind") == 1)
    if spans is not None:
        carried = spans.carry(d, F.col("_ver"), F.struct("_at", "_tie"))
        out = out.join(carried, [key, "_span"], "left").withColumn(
            "_seen", F.coalesce("_seen", "_carry")
        )
    valid = F.col(ts) < _open_end(F.col(f"_seen.{valid_to}"))
    out = out.withColumn("_seen", F.when(F.col("_seen").isNotNull() & valid, F.col("_seen")))
    if how == "inner":
        out = out.filter(F.col("_seen").isNotNull())
    return out.select(*fact.columns, *[F.col(f"_seen.{c}").alias(c) for c in dim_cols])
