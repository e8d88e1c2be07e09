"""Streaming ingest: every landed file once, into the same bronze, quarantine and run log as the batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hourlake.plans.ingest import KEPT, MALFORMED, classify_lines, line_counters, parse_or_isolate, run_log_rows
from hourlake.schemas import BRONZE, DEFAULT_EVENT_TYPES, RUN_LOG
from hourlake.session import pin_utc
from hourlake.sources.bronze import partition_columns, read_bronze, write_bronze
from hourlake.sources.files import read_or_empty
from hourlake.sources.landing import hour_of_path
from hourlake.sources.scratch import written
from hourlake.sources.tables import append


def stream_lines(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Lines of files as they land; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.gz")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(landing).select("value", F.col("_metadata.file_path").alias("source_file"))


def stream_events(
    lines: DataFrame, event_types: Sequence[str] = DEFAULT_EVENT_TYPES, stamp: datetime | Column | None = None
) -> DataFrame:
    """Classified rows (see ``classify_lines``), stamped with the micro-batch's time unless ``stamp`` is given."""
    if stamp is None:
        stamp = F.current_timestamp().cast("timestamp_ntz")
    hour = hour_of_path(F.col("source_file"))
    return classify_lines(lines.withColumn("file_hour", hour), event_types, stamp)


def _merged(spark: SparkSession, new: DataFrame, root: str, layout: list[str], stored: DataFrame) -> None:
    """Put ``new`` into its hours: rows of the same files are replaced, rows of other files stay."""
    touched = new.select("event_date", "hour").distinct()
    files = new.select("source_file").distinct()
    kept = stored.join(touched, ["event_date", "hour"], "left_semi").join(files, "source_file", "left_anti")
    write_bronze(kept.select(*layout).unionByName(new.select(*layout)).hint("rebalance", "event_date", "hour"), root)


def ingest_batch(
    rows: DataFrame,
    batch: str,
    bronze: str,
    run_log: str | None = None,
    quarantine: str | None = None,
    finished_at: datetime | None = None,
) -> None:
    """One micro-batch of classified rows into bronze, quarantine and run log; running it again changes nothing."""
    spark = rows.sparkSession
    started = datetime.now(UTC).replace(tzinfo=None)
    day, hour = partition_columns(F.col("file_hour"))
    rows = written(rows.filter(F.col("file_hour").isNotNull()).withColumns({"event_date": day, "hour": hour}), "micro-batch")
    keys = ["event_date", "hour"]
    _merged(spark, rows.filter(F.col("outcome") == KEPT), bronze, [*BRONZE.names, *keys], read_bronze(spark, bronze))
    if quarantine:
        lost = "source_file string, raw string, event_date date, hour string"
        stored = read_or_empty(spark, quarantine, lost)
        _merged(spark, rows.filter(F.col("outcome") == MALFORMED), quarantine, ["source_file", "raw", *keys], stored)
    if run_log:
        counts = line_counters(rows, "file_hour").withColumnRenamed("file_hour", "hour")
        none = F.lit(None)
        outcomes = counts.select(
            "hour", F.lit("success").alias("status"), "rows_read", "rows_kept", "malformed_rows",
            none.cast("bigint").alias("bytes_written"), none.cast("string").alias("error_message"),
        )
        finished = finished_at or datetime.now(UTC).replace(tzinfo=None)
        _log_once(run_log_rows(outcomes, batch, started, finished), run_log)


def arrivals(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """``path, length`` of files as they land; their content is not read. ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing).select("path", "length")


def stream_to_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    event_types: Sequence[str] = DEFAULT_EVENT_TYPES,
    max_files: int | None = None,
    run_log: str | None = None,
    quarantine: str | None = None,
    ingested_at: datetime | None = None,
) -> StreamingQuery:
    """Ingest all files not seen before and stop. The checkpoint makes every file count once.

    What is streamed is the arrival of files; each micro-batch reads its files as the batch ingest does, into the same tables.
    If one of them is unreadable, all files of the micro-batch are verified, the hours that have an unreadable one are logged
    as ``failed`` with the error, and the others are ingested; a later batch ingest takes the failed hours again. An hour whose files
    come in several micro-batches is logged once for each, with the counts of its part.
    """
    pin_utc(spark)

    def put(batch_files: DataFrame, batch_id: int) -> None:
        started = datetime.now(UTC).replace(tzinfo=None)
        batch = f"{checkpoint}#{batch_id}"
        # names of the micro-batch's files, at most ``max_files``
        paths = [r["path"] for r in batch_files.select("path").collect()]
        rows, bad = parse_or_isolate(spark, paths, event_types, ingested_at or started)
        if rows is not None:
            ingest_batch(rows.withColumnRenamed("hour", "file_hour"), batch, bronze, run_log, quarantine)
        if bad and run_log:
            log_failures(spark, bad, f"{batch}!", run_log, started)

    return (
        arrivals(spark, landing, max_files)
        .writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def log_failures(spark: SparkSession, bad: list[tuple[str, str]], batch: str, run_log: str, started: datetime) -> None:
    """A ``failed`` row for each hour of the unreadable files ``(path, error)``."""
    files = spark.createDataFrame(bad, "path string, error string")
    hours = files.groupBy(hour_of_path(F.col("path")).alias("hour")).agg(F.min(F.concat_ws(": ", "error", "path")).alias("error_message"))
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("rows_read", "rows_kept", "malformed_rows", "bytes_written")]
    outcomes = hours.filter(F.col("hour").isNotNull()).select("hour", F.lit("failed").alias("status"), *zero, "error_message")
    _log_once(run_log_rows(outcomes, batch, started, datetime.now(UTC).replace(tzinfo=None)), run_log)


def _log_once(log: DataFrame, run_log: str) -> None:
    """Append run-log rows; a repeated micro-batch has the same run ids."""
    done = read_or_empty(log.sparkSession, run_log, RUN_LOG).select("run_id")
    append(written(log.join(done, "run_id", "left_anti"), "runs").coalesce(1), run_log)
