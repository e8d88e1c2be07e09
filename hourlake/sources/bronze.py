"""Bronze: typed events in ``event_date=YYYY-MM-DD/hour=HH`` folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourlake.schemas import BRONZE, BRONZE_PARTITIONS
from hourlake.sources.files import read_or_empty

_LAYOUT = T.StructType(BRONZE.fields + BRONZE_PARTITIONS.fields)


def partition_columns(hour: Column) -> tuple[Column, Column]:
    """Directory keys of an hour. They come from the file's hour, not from ``created_at``."""
    return F.to_date(hour).alias("event_date"), F.date_format(hour, "HH").alias("hour")


def write_bronze(df: DataFrame, root: str) -> None:
    """Replace exactly the ``(event_date, hour)`` folders present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("event_date", "hour")
        .parquet(root)
    )


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Every bronze row, with the two directory keys as columns (they prune the scan)."""
    return read_or_empty(spark, root, _LAYOUT)
