"""Retention: what has expired, what it would free, and the view without it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def cutoff(today: date, days: int) -> date:
    """First day that is kept; a partition expires only when older than this."""
    if days < 1:
        raise ValueError("days must be at least 1")
    return today - timedelta(days=days)


def partition_date(path: Column) -> Column:
    return F.regexp_extract(path, r"event_date=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def expired_partitions(files: DataFrame, today: date, days: int) -> DataFrame:
    """Expired dates with file count and bytes, from a listing ``(path, length)``.

    Files outside ``event_date=…`` folders are never listed.
    """
    return (
        files.select(partition_date(F.col("path")).alias("event_date"), "length")
        .filter(F.col("event_date") < F.lit(cutoff(today, days)))
        .groupBy("event_date")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def reclaimable(expired: DataFrame, today: date, days: int) -> DataFrame:
    """One row: cutoff, and dates, files and bytes that removal would free (zeros if none)."""
    return expired.agg(
        F.lit(cutoff(today, days)).alias("cutoff_date"),
        F.count("*").alias("dates_expired"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files_expired"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_reclaimable"),
    )


def retained(bronze: DataFrame, today: date, days: int) -> DataFrame:
    """Unexpired rows; the filter is on the partition column and prunes whole folders."""
    return bronze.filter(F.col("event_date") >= F.lit(cutoff(today, days)))
