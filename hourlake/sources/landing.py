"""The landing zone: hourly newline-delimited JSON, gzip-compressed.

An hour is named ``YYYY-MM-DD-H.json.gz`` (hour not zero-padded). It may be one file, or a folder
of that name holding several part files: gzip cannot be split, so large hours land in parts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourlake.functions.time import ntz
from hourlake.sources.files import list_files, path_exists

# Fixed value: naming of an hour in the feed.
HOUR_NAME = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json\.gz"
#: Key of the folders if Spark has landed the hours itself.
PART = "hour_file"


def hour_of_path(path: Column) -> Column:
    """The hour a landing path belongs to, or NULL."""
    day = F.regexp_extract(path, HOUR_NAME, 1)
    hour = F.regexp_extract(path, HOUR_NAME, 2)
    return F.concat(day, F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":00:00")).try_cast("timestamp_ntz")


def hour_name(hour: datetime) -> str:
    """Name of an hour in the landing zone."""
    return f"{hour:%Y-%m-%d}-{hour.hour}.json.gz"


def hour_path(spark: SparkSession, landing: str, hour: datetime) -> str | None:
    """Where an hour has landed, as a file, a folder or a partition folder of that name; None if it hasn't."""
    name = hour_name(hour)
    return next((p for p in (f"{landing}/{name}", f"{landing}/{PART}={name}") if path_exists(spark, p)), None)


def hour_range(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Every hour from ``start`` to ``end``, both included, in a column ``hour``."""
    for at in (start, end):
        if at != at.replace(minute=0, second=0, microsecond=0):
            raise ValueError(f"not a whole hour: {at!r}")
    if end < start:
        raise ValueError(f"no hour lies between {start} and {end}")
    return spark.range(1).select(
        F.explode(F.sequence(ntz(start), ntz(end), F.expr("INTERVAL 1 HOUR"))).alias("hour")
    )


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    """``(hour, path, length)`` of every landed file."""
    return (
        list_files(spark, landing, "*.gz")
        .withColumn("hour", hour_of_path(F.col("path")))
        .filter(F.col("hour").isNotNull())
        .select("hour", "path", "length")
    )


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(value, source_file)`` for every line; only ``\\n`` ends a line, as in the feed."""
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz")
        .text(paths)
        .select("value", F.col("_metadata.file_path").alias("source_file"))
    )
