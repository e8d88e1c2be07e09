"""Streaming dedupe, upsert and hourly volume.

Watermarks need an instant, so ``created_at`` (zone-less UTC) is cast for them; the session zone is
UTC. The default delay is the two hours by which the feed may be late. Rows later than that are
dropped by stateful operators and come in with the next batch backfill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hourlake.functions import date_key, event_hour
from hourlake.operators.dedupe import latest_per_key
from hourlake.operators.upsert import upsert_table

LATE_BY = "2 hours"


def with_watermark(events: DataFrame, delay: str = LATE_BY) -> DataFrame:
    return events.withColumn("event_time", F.col("created_at").cast("timestamp")).withWatermark(
        "event_time", delay
    )


def dedupe_stream(events: DataFrame, key: str = "event_id", delay: str = LATE_BY) -> DataFrame:
    """First-seen row per key; state is kept for the delay only.

    Keeps the *first* copy, unlike the batch dedupe: use ``upsert_stream`` if corrections matter.
    """
    return with_watermark(events, delay).dropDuplicatesWithinWatermark([key]).drop("event_time")


def hourly_volume_stream(events: DataFrame, delay: str = LATE_BY) -> DataFrame:
    """Events per tumbling hour. In append mode the newest windows stay open; see ``volume_to_table``."""
    counts = with_watermark(events, delay).groupBy(F.window("event_time", "1 hour")).count()
    start = F.col("window.start").cast("timestamp_ntz")
    return counts.select(
        date_key(start).alias("date_key"),
        event_hour(start).alias("event_hour"),
        F.col("count").alias("event_count"),
    )


def _each_batch(df: DataFrame, apply, checkpoint: str, mode: str) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _batch_id: apply(batch))
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    schema,
    keys: Sequence[str] = ("event_id",),
    order: Sequence[str] = ("ingested_at",),
    partition: str = "date_key",
) -> StreamingQuery:
    """Keep a partitioned table at one row per key, the latest copy winning.

    Within a micro-batch the latest copy is picked; against the table, equal keys are replaced. A
    repeated batch therefore changes nothing, which makes the sink exactly-once.
    """

    def apply(batch: DataFrame) -> None:
        latest = latest_per_key(batch, list(keys), list(order))
        upsert_table(batch.sparkSession, path, latest, list(keys), partition, schema)

    return _each_batch(events, apply, checkpoint, "append")


VOLUME_SCHEMA = "date_key int, event_hour bigint, event_count bigint"


def volume_to_table(events: DataFrame, path: str, checkpoint: str, delay: str = LATE_BY) -> StreamingQuery:
    """Maintain the hourly-volume table: changed hours are upserted, so open windows show too."""

    def apply(batch: DataFrame) -> None:
        keys = ["date_key", "event_hour"]
        upsert_table(batch.sparkSession, path, batch, keys, "date_key", VOLUME_SCHEMA)

    return _each_batch(hourly_volume_stream(events, delay), apply, checkpoint, "update")
