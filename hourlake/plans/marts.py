"""Marts over the event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourlake.functions import event_hour, hours_before
from hourlake.operators.percentiles import grouped_percentiles
from hourlake.operators.skew import HEAVY_ROWS, salted_join


def daily_repo_activity(
    fact: DataFrame, dim_date: DataFrame, dim_event_type: DataFrame, push_type: str = "PushEvent"
) -> DataFrame:
    """Per repository, day and category: events, distinct actors, pushes.

    Events outside the calendar or of an unknown type drop out (the foreign-key checks report them).
    ``distinct_contributors`` does not add up over rows; see ``contributors`` for weeks and months.
    """
    # Both sides are bounded by construction: a calendar of days and the list of event types.
    days = F.broadcast(dim_date.select("date_key", "date_day"))
    types = F.broadcast(dim_event_type.select("event_type_key", "category"))
    return (
        fact.filter(F.col("repo_id").isNotNull())
        .select("repo_id", "date_key", "event_type_key", "event_type", "actor_id")
        .join(days, "date_key")
        .join(types, "event_type_key")
        .groupBy("repo_id", "date_key", "date_day", "category")
        .agg(
            F.count("*").alias("event_count"),
            F.countDistinct("actor_id").alias("distinct_contributors"),
            F.count_if(F.col("event_type") == push_type).alias("push_event_count"),
        )
    )


CONTRIBUTORS = "repo_id bigint, category string, bucket bigint, actors binary, date_key int"


def daily_contributors(fact: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    """Who acted, as exact bitmaps that can be merged: ``repo_id, date_key, category, bucket, actors``.

    A bitmap holds the actors of one range of 32,768 ids; it is mostly zeros and small when stored. A day's rows depend
    on that day alone, so a table of them is kept up to date by replacing the days that change.
    """
    types = F.broadcast(dim_event_type.select("event_type_key", "category"))
    rows = fact.filter(F.col("repo_id").isNotNull() & F.col("actor_id").isNotNull()).select("repo_id", "date_key", "event_type_key", "actor_id")
    # Each actor once before bits are set: a bitmap per row would be far larger than the row.
    each = rows.join(types, "event_type_key").select("repo_id", "category", "date_key", "actor_id").distinct()
    return each.groupBy("repo_id", "category", F.bitmap_bucket_number("actor_id").alias("bucket"), "date_key").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("actor_id")).alias("actors")
    ).select("repo_id", "category", "bucket", "actors", "date_key")


def contributors(daily: DataFrame, unit: str) -> DataFrame:
    """``repo_id, category, period, distinct_contributors`` by ``week`` or ``month`` (``period`` is its first day).

    Bitmaps of the days are merged, never counts; the fact is not read.
    """
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    merged = daily.groupBy("repo_id", "category", F.trunc(day, unit).alias("period"), "bucket").agg(F.bitmap_or_agg("actors").alias("actors"))
    return merged.groupBy("repo_id", "category", "period").agg(F.sum(F.bitmap_count("actors")).alias("distinct_contributors"))


PACES = "repo_id bigint, seconds bigint, merges bigint, date_key int"
_PACE = {"repo_p50_hours_to_merge": 0.5, "repo_p95_hours_to_merge": 0.95}


def daily_paces(fact: DataFrame) -> DataFrame:
    """How often each time to merge occurs, ``repo_id, seconds, merges, date_key``: a day's rows depend on that day alone.

    The counts of all days merge to exact percentiles (``repo_paces``), so only days that change are counted anew.
    """
    rows = fact.filter(F.col("is_pr_merged") & F.col("hours_to_merge").isNotNull())
    seconds = F.round(F.col("hours_to_merge") * 3600).cast("bigint").alias("seconds")
    return rows.groupBy("repo_id", seconds, "date_key").agg(F.count("*").alias("merges")).select("repo_id", "seconds", "merges", "date_key")


def repo_paces(daily: DataFrame) -> DataFrame:
    """``repo_id`` with its exact p50 and p95 hours to merge, from stored counts."""
    return grouped_percentiles(daily, ["repo_id"], F.col("seconds"), 3600.0, _PACE, weight="merges")


def pr_lifecycle_mart(fact: DataFrame, heavy_rows: int = HEAVY_ROWS, paces: DataFrame | None = None) -> DataFrame:
    """One row per merge with a known opening, next to its repository's p50 and p95.

    The percentiles (``paces``, or else counted from the fact) come from an aggregate, which adaptive execution
    can't split in a join, so a repository with very many merges is salted.
    """
    rows = fact.filter(F.col("is_pr_merged") & F.col("hours_to_merge").isNotNull()).select(
        "repo_id", "pr_number", "created_at", "hours_to_merge"
    )
    pace = paces
    if pace is None:
        pace = grouped_percentiles(rows, ["repo_id"], F.round(F.col("hours_to_merge") * 3600), 3600.0, _PACE)
    return salted_join(rows, pace, ["repo_id"], "inner", heavy_rows).select(
        "repo_id",
        "pr_number",
        hours_before("created_at", "hours_to_merge").alias("opened_at"),
        F.col("created_at").alias("merged_at"),
        "hours_to_merge",
        "repo_p50_hours_to_merge",
        "repo_p95_hours_to_merge",
    )


def hourly_volume(fact: DataFrame) -> DataFrame:
    """Events per calendar hour."""
    return fact.groupBy("date_key", event_hour("created_at").alias("event_hour")).agg(
        F.count("*").alias("event_count")
    )
