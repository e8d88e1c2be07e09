"""Ready-made reads over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F


def activity_named(activity: DataFrame, dim_date: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """Daily activity with weekend flag and the repository's current name (NULL if unknown)."""
    days = F.broadcast(dim_date.select("date_key", "is_weekend"))
    names = dim_repo.filter("is_current").select("repo_id", "repo_name")
    return (
        activity.join(days, "date_key")
        .join(names, "repo_id", "left")
        .select(
            "repo_id",
            "date_key",
            "category",
            "event_count",
            "distinct_contributors",
            "date_day",
            "is_weekend",
            "repo_name",
        )
    )


def in_range(df: DataFrame, col: str, start: date, end: date) -> DataFrame:
    """Rows whose day lies between two dates, both included."""
    return df.filter(F.to_date(col).between(F.lit(start), F.lit(end)))


def activity_filtered(named: DataFrame, start: date, end: date, categories: Sequence[str]) -> DataFrame:
    return in_range(named, "date_day", start, end).filter(F.col("category").isin(*categories))


def hourly_series(volume: DataFrame, dim_date: DataFrame, start: date, end: date) -> DataFrame:
    """Events per hour with a real timestamp, in time order."""
    days = F.broadcast(in_range(dim_date, "date_day", start, end).select("date_key", "date_day"))
    hour = F.make_dt_interval(F.lit(0), F.col("event_hour").cast("int"))
    return (
        volume.join(days, "date_key")
        .select((F.col("date_day") + hour).alias("timestamp"), "event_count")
        .orderBy("timestamp")
    )


def top_repos(named: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most active named repositories; ties go to the lower id."""
    return (
        named.filter(F.col("repo_name").isNotNull())
        .groupBy("repo_id", "repo_name")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.desc("event_count"), "repo_id")
        .limit(k)
    )


def merge_time_histogram(lifecycle: DataFrame, start: date, end: date, bins: int = 30) -> DataFrame:
    """Equal-width histogram of ``hours_to_merge``: ``bin`` (from 1), its bounds and count."""
    rows = in_range(lifecycle, "merged_at", start, end).select("hours_to_merge")
    ends = F.struct(F.min("hours_to_merge").alias("lo"), F.max("hours_to_merge").alias("hi"))
    span = rows.agg(ends).scalar()
    lo = span["lo"]
    width = (span["hi"] - lo) / F.lit(float(bins))
    # All values equal: one bin. The largest value belongs to the last bin.
    index = F.when(width == 0, F.lit(0)).otherwise(F.floor((F.col("hours_to_merge") - lo) / F.nullif(width, F.lit(0.0))))
    return (
        rows.groupBy((F.least(index, F.lit(bins - 1)) + 1).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"), (lo + F.col("bin") * width).alias("bin_end"), "n")
    )


def weekend_split(named: DataFrame) -> DataFrame:
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type")
    return named.groupBy(day_type).agg(F.sum("event_count").alias("event_count"))


def latest_runs(runs: DataFrame, k: int = 48) -> DataFrame:
    """The newest ``k`` runs: when, how they ended, what they wrote."""
    return (
        runs.select("started_at", "run_id", "status", "rows_written")
        .orderBy(F.desc("started_at"), "run_id")
        .limit(k)
    )


def latest_check_result(results: DataFrame) -> DataFrame:
    """The newest check summary with its pass rate (NULL without checks)."""
    return (
        results.orderBy(F.desc("recorded_at"), "run_id")
        .limit(1)
        .withColumn("pass_rate", F.try_divide(F.col("passed_tests").cast("double"), F.col("total_tests")))
    )


def filter_choices(activity: DataFrame) -> DataFrame:
    """One row: distinct categories (sorted) and the first and last day with activity."""
    return activity.agg(
        F.array_sort(F.collect_set("category")).alias("categories"),
        F.to_date(F.min("date_day")).alias("min_date"),
        F.to_date(F.max("date_day")).alias("max_date"),
    )
