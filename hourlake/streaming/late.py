"""Hourly volume that keeps what the watermark shuts out: rows of closed hours come out at the side, for the batch path.

Spark's own windowed aggregate drops such rows without a word. Here a stateful operator decides for each row: an hour that is
open counts it, an hour that the watermark has closed hands the whole row on as *late*. Every row is therefore either in a count
or in the side table, whatever the micro-batches were, and both together equal a batch count.

State is one number for each open hour and piece (an hour's rows are dealt over ``PIECES`` keys, so that a busy hour is not one
task's work); a timer at the hour's end removes it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from hourlake.functions import date_key, event_hour
from hourlake.operators.upsert import upsert_table
from hourlake.session import DEFAULTS, pin_utc
from hourlake.sources.files import read_or_empty
from hourlake.sources.manifest import current
from hourlake.sources.scratch import written
from hourlake.streaming.events import LATE_BY, with_watermark

#: Keys over which an hour's rows are dealt.
PIECES = 16
COUNTS_SCHEMA = "date_key int, event_hour bigint, piece int, event_count bigint"
_OUT = "hour bigint, piece int, late boolean, n bigint, row string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for the streams started inside: Spark's default store has no timers. A stream copies the settings as it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _processor() -> StatefulProcessor:
    """Made here, so that workers need not have this package."""
    from pyspark.sql.streaming import StatefulProcessor

    class HourCount(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.count = handle.getValueState("count", "n bigint")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            import pandas as pd

            hour, piece = key
            end = (hour + 1) * 3_600_000
            if timerValues.getCurrentWatermarkInMs() >= end:
                for part in rows:
                    yield pd.DataFrame({"hour": hour, "piece": piece, "late": True, "n": 1, "row": part["row"]})
                return
            n = sum(len(part) for part in rows)
            if self.count.exists():
                n += self.count.get()[0]
            self.count.update((n,))
            self.handle.registerTimer(end)
            yield pd.DataFrame({"hour": [hour], "piece": [piece], "late": [False], "n": [n], "row": [None]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.count.clear()
            return iter(())

        def close(self) -> None:
            pass

    return HourCount()


def counted_or_late(events: DataFrame, delay: str = LATE_BY, pieces: int = PIECES) -> DataFrame:
    """``hour`` (since 1970), ``piece, late, n, row``: running counts of open hours, and late rows as JSON."""
    marked = with_watermark(events, delay)
    # a plain number does not carry the watermark, so Spark leaves closed hours to the operator
    hour = F.floor(F.unix_micros("event_time") / 3_600_000_000)
    rows = marked.filter(F.col("event_time").isNotNull()).select(
        hour.alias("hour"), F.pmod(F.xxhash64(*events.columns), F.lit(pieces)).cast("int").alias("piece"), F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("row")
    )
    return rows.groupBy("hour", "piece").transformWithStateInPandas(_processor(), _OUT, "Update", "EventTime")


def volume_and_late_rows(events: DataFrame, path: str, late_path: str, checkpoint: str, delay: str = LATE_BY, pieces: int = PIECES) -> StreamingQuery:
    """Maintain the counts of ``stored_volume`` and the side table of ``late_rows``; a repeated micro-batch changes nothing.

    The checkpoint fixes ``pieces``. The session may have any state store: this stream's is RocksDB.
    """
    schema, spark = events.schema, events.sparkSession
    pin_utc(spark)

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = written(batch, "late-or-counted")
        at = F.timestamp_seconds(F.col("hour") * 3600).cast("timestamp_ntz")
        counts = rows.filter("not late").select(date_key(at).alias("date_key"), event_hour(at).alias("event_hour"), "piece", F.col("n").alias("event_count"))
        upsert_table(spark, path, counts, ["date_key", "event_hour", "piece"], "date_key", COUNTS_SCHEMA)
        late = rows.filter("late").select(F.from_json("row", schema).alias("r")).select("r.*")
        late.write.mode("overwrite").option("compression", "zstd").parquet(f"{late_path}/_batch={batch_id}")

    stream = counted_or_late(events, delay, pieces).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint)
    with _rocksdb(spark):
        return stream.trigger(availableNow=True).start()


def stored_volume(spark, path: str) -> DataFrame:
    """The streamed volume, ``date_key, event_hour, event_count``."""
    counts = current(spark, path, COUNTS_SCHEMA)
    return counts.groupBy("date_key", "event_hour").agg(F.sum("event_count").alias("event_count"))


def late_rows(spark, late_path: str, schema) -> DataFrame:
    """All rows that came after their hour was closed, for the batch path."""
    rows = read_or_empty(spark, late_path, schema)
    return rows.drop("_batch")


def recovered_volume(streamed: DataFrame, late: DataFrame) -> DataFrame:
    """What a batch over all rows would count."""
    missed = late.groupBy(date_key("created_at").alias("date_key"), event_hour("created_at").alias("event_hour")).agg(F.count(F.lit(1)).alias("event_count"))
    return streamed.unionByName(missed).groupBy("date_key", "event_hour").agg(F.sum("event_count").alias("event_count"))


__all__ = ["COUNTS_SCHEMA", "counted_or_late", "late_rows", "recovered_volume", "stored_volume", "volume_and_late_rows"]
