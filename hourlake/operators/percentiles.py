"""Exact, linearly interpolated percentiles that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    code: Column,
    unit: float,
    probs: dict[str, float],
    low_bits: int = 16,
    weight: str | None = None,
) -> DataFrame:
    """``keys…`` and one column per entry of ``probs`` (``{column name: probability}``).

    ``code`` is the value as a whole number of ``1/unit`` (seconds for hours with ``unit=3600``);
    the result is in the original unit. NULL codes are ignored; groups without values are absent. With ``weight``, a row
    stands for that many equal values: stored counts of values, say one table of them per day, merge to exact percentiles.

    Selection by counting: equal values are first counted (partial aggregation, shuffled by value,
    so a huge group is spread), then a coarse histogram of ``code >> low_bits`` finds the few buckets
    that hold the wanted ranks, and only the distinct values of those buckets are ranked. No task
    sees more than the buckets of a key or ``2**low_bits`` values, however many rows the key has.
    """
    keys = list(keys) or ["_all"]
    src = df if keys != ["_all"] else df.withColumn("_all", F.lit(0))
    counts = (
        src.select(*keys, code.cast("bigint").alias("_code"), (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("_w"))
        .filter(F.col("_code").isNotNull())
        .groupBy(*keys, "_code")
        .agg(F.count("*").alias("_n") if weight is None else F.sum("_w").alias("_n"))
        .withColumn("_bucket", F.shiftright("_code", low_bits))
    )
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    coarse = (
        counts.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_before", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_bn").over(by_key))
    )

    def rank(p: float, up: bool) -> Column:
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        return (F.ceil(pos) if up else F.floor(pos)).cast("bigint")

    wanted = F.lit(False)
    for p in probs.values():
        for up in (False, True):
            r = rank(p, up)
            wanted = wanted | ((F.col("_before") <= r) & (r < F.col("_before") + F.col("_bn")))
    target = coarse.filter(wanted).select(*keys, "_bucket", "_before", "_total")

    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_code")
    # Null-safe, so that a NULL group is a group, and so that both uses of the counts stay the same
    # subplan and share one scan and shuffle.
    target = target.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate([*keys, "_bucket"])], "_before", "_total")
    same = F.lit(True)
    for i, k in enumerate([*keys, "_bucket"]):
        same = same & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    running = F.sum("_n").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0))
    fine = counts.join(target, same).withColumn("_upto", F.col("_before") + running)
    picks = []
    for name, p in probs.items():
        for up in (False, True):
            hit = F.when(F.col("_upto") > rank(p, up), F.col("_code"))
            picks.append((F.min(hit) / F.lit(float(unit))).alias(f"_{name}_{'hi' if up else 'lo'}"))
    found = fine.groupBy(*keys).agg(F.first("_total").alias("_total"), *picks)
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return found.select(*[k for k in keys if k != "_all"], *out)
