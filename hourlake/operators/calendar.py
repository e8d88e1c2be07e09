"""Generated calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourlake.functions.keys import date_key

# First and last day of the calendar.
FIRST_DAY, LAST_DAY = date(2015, 1, 1), date(2030, 12, 31)


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day; ``day_of_week`` counts from 0 = Sunday, ``iso_week`` is the ISO week."""
    day = F.col("d")
    dow = (F.dayofweek(day) - 1).cast("bigint")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("d"))
        .select(
            date_key(day).alias("date_key"),
            day.cast("timestamp_ntz").alias("date_day"),
            dow.alias("day_of_week"),
            dow.isin(0, 6).alias("is_weekend"),
            F.weekofyear(day).cast("bigint").alias("iso_week"),
            F.month(day).cast("bigint").alias("month"),
            F.quarter(day).cast("bigint").alias("quarter"),
            F.year(day).cast("bigint").alias("year"),
        )
    )
