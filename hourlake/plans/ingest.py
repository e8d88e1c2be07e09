"""Landing files to bronze.

All requested hours go through one Spark job. Every line is parsed once; the parsed, projected rows
(a few percent of the raw size) are written to shared scratch, and counters, bronze, quarantine and
run log are all derived from that copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourlake.functions.time import iso_to_utc, ntz
from hourlake.schemas import BRONZE, DEFAULT_EVENT_TYPES, RUN_LOG
from hourlake.session import pin_utc
from hourlake.sources.bronze import partition_columns, write_bronze
from hourlake.sources.files import path_exists, read_or_empty, remove_folders
from hourlake.sources.gzip_check import gzip_errors
from hourlake.sources.landing import hour_of_path, hour_path, read_lines
from hourlake.sources.scratch import written
from hourlake.sources.tables import append

KEPT, FILTERED, MALFORMED = "kept", "filtered", "malformed"

OUTCOME = (
    "hour timestamp_ntz, status string, rows_read bigint, rows_kept bigint, "
    "malformed_rows bigint, bytes_written bigint, error_message string"
)

# Only the fields bronze keeps are declared, so the JSON parser skips everything else. All leaves are
# text: a wrongly typed optional field then costs that field, not the row.
_LINE = """array<struct<
  id string, type string, created_at string, z string,
  actor struct<id string, login string>,
  repo struct<id string, name string>,
  org struct<id string>,
  payload struct<action string,
                 pull_request struct<number string>,
                 issue struct<number string>>>>"""
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}

_REQUIRED = ("event_id", "created_at", "actor_id", "actor_login")
_NUMERIC_OPTIONAL = {
    "repo_id": ("e.repo.id", "bigint"),
    "org_id": ("e.org.id", "bigint"),
    "pr_number": ("e.payload.pull_request.number", "int"),
    "issue_number": ("e.payload.issue.number", "int"),
}


def classify_lines(
    lines: DataFrame,
    event_types: Sequence[str] = DEFAULT_EVENT_TYPES,
    ingested_at: datetime | Column | None = None,
) -> DataFrame:
    """Every non-blank line as one row: bronze columns plus ``outcome``, ``nulled_fields``, ``raw``.

    ``outcome`` is ``malformed`` (not a JSON object, or a required field missing or uncastable),
    ``filtered`` (other event type; tested before the fields are) or ``kept``. ``nulled_fields``
    counts optional numbers that had to become NULL; ``raw`` keeps the text of malformed lines.
    Columns of ``lines`` other than ``value`` are passed through; ``source_file`` must be there.
    """
    if ingested_at is None:
        ingested_at = datetime.now(UTC).replace(tzinfo=None)
    stamp = ingested_at if isinstance(ingested_at, Column) else ntz(ingested_at)
    extra = [c for c in lines.columns if c not in ("value", "source_file")]

    # As the first of two array elements, the second of which carries the line's hash: text before or after
    # the object is an error or changes the number of elements, and a line that closes the array early
    # hides the second one, because it can't contain its own hash.
    seal = F.hex(F.xxhash64("value"))
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit(',{"z":"'), seal, F.lit('"}]'))
    elements = F.from_json(wrapped, _LINE, _JSON_OPTIONS)
    sealed = (F.size("_found") == 2) & (F.get("_found", F.lit(1))["z"] == seal)
    parsed = (
        lines.filter(~F.col("value").rlike(r"^\s*$"))
        .withColumn("_found", F.when(F.is_valid_utf8("value"), elements))
        # Through a generator: filters on the result then stay above it, instead of being pushed down
        # as copies that would parse the line again for every field they test.
        .withColumn("e", F.explode(F.array(F.when(sealed, F.get("_found", F.lit(0))))))
        .drop("_found")
    )
    nulled = F.lit(0)
    for path, kind in _NUMERIC_OPTIONAL.values():
        lost = F.col(path).isNotNull() & F.col(path).try_cast(kind).isNull()
        nulled = nulled + lost.cast("int")
    fields = {
        "event_id": F.col("e.id").try_cast("bigint"),
        "event_type": F.col("e.type"),
        "created_at": iso_to_utc("e.created_at"),
        "actor_id": F.col("e.actor.id").try_cast("bigint"),
        "actor_login": F.col("e.actor.login"),
        "repo_name": F.col("e.repo.name"),
        "action": F.col("e.payload.action"),
        "ingested_at": stamp,
        "source_file": F.col("source_file"),
        **{name: F.col(p).try_cast(kind) for name, (p, kind) in _NUMERIC_OPTIONAL.items()},
    }
    typed = parsed.select(
        *[fields[c].alias(c) for c in BRONZE.names],
        *extra,
        nulled.alias("nulled_fields"),
        F.col("e").isNull().alias("_broken"),
        F.col("value").alias("_value"),
    )
    incomplete = F.lit(False)
    for c in _REQUIRED:
        incomplete = incomplete | F.col(c).isNull()
    wanted = F.coalesce(F.col("event_type").isin(*event_types), F.lit(False))
    outcome = (
        F.when(F.col("_broken"), MALFORMED)
        .when(~wanted, FILTERED)
        .when(incomplete, MALFORMED)
        .otherwise(KEPT)
    )
    return (
        typed.withColumn("outcome", outcome)
        .withColumn("raw", F.when(F.col("outcome") == MALFORMED, F.col("_value")))
        .drop("_broken", "_value")
    )


def parse_events(
    lines: DataFrame,
    event_types: Sequence[str] = DEFAULT_EVENT_TYPES,
    ingested_at: datetime | Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(good, malformed)``: bronze rows, and ``(source_file, raw)`` of lines to quarantine."""
    rows = classify_lines(lines, event_types, ingested_at)
    return (
        rows.filter(F.col("outcome") == KEPT).select(*BRONZE.names),
        rows.filter(F.col("outcome") == MALFORMED).select("source_file", "raw"),
    )


def line_counters(rows: DataFrame, by: str = "source_file") -> DataFrame:
    """Read = kept + filtered + malformed, per file (or per any other column of ``rows``)."""
    return rows.groupBy(by).agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("outcome") == KEPT).alias("rows_kept"),
        F.count_if(F.col("outcome") == FILTERED).alias("filtered_rows"),
        F.count_if(F.col("outcome") == MALFORMED).alias("malformed_rows"),
        F.sum(F.when(F.col("outcome") == KEPT, F.col("nulled_fields")).otherwise(0)).alias("nulled_fields"),
    )


def unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, error)`` of the files below the paths that do not decompress; only run after a read has failed.

    Files are streamed, so their size does not matter. Only their names pass through the driver.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    files = [r["path"] for r in listed.load(paths).select("path").collect()]
    return gzip_errors(spark, files).filter(F.col("error").isNotNull())


def done_hours(run_log: DataFrame) -> DataFrame:
    """Hours that were ingested successfully, including those that kept no row."""
    ok = run_log.filter(F.col("status") == "success")
    return ok.select(F.col("hour_processed").alias("hour")).distinct()


def missing_hours(hours: DataFrame, done: DataFrame) -> DataFrame:
    """Requested hours that are not done yet."""
    return hours.join(done, "hour", "left_anti")


def ingest_hours(
    spark: SparkSession,
    landing: str,
    bronze: str,
    run_log: str,
    hours: DataFrame,
    *,
    event_types: Sequence[str] = DEFAULT_EVENT_TYPES,
    ingested_at: datetime | None = None,
    force: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """Ingest the given hours (column ``hour``) and return one outcome row per hour.

    A single hour, a scheduled run and a backfill are the same call. Hours already done are
    ``skipped`` unless ``force``, which replaces them. An hour whose file is absent or unreadable is
    ``failed`` and nothing of it is written; the other hours are not affected. Attempts are appended
    to the run log, skips are not.
    """
    pin_utc(spark)
    started = datetime.now(UTC).replace(tzinfo=None)
    stamp = ingested_at or started
    batch = uuid.uuid4().hex
    log = read_or_empty(spark, run_log, RUN_LOG)

    wanted = written(hours.select("hour").distinct(), "hours")
    todo = wanted if force else missing_hours(wanted, done_hours(log))
    # One entry per requested hour, bounded by the calendar: its place follows from its name, so
    # neither other hours nor the hour's own files are listed here.
    places = [(r[0], hour_path(spark, landing, r[0])) for r in todo.select("hour").collect()]
    found = spark.createDataFrame(places, "hour timestamp_ntz, path string")
    todo = found.select("hour")
    paths = [p for _, p in places if p is not None]

    rows, bad = parse_or_isolate(spark, paths, event_types, stamp)
    errors = found.select(
        "hour", F.when(F.col("path").isNull(), F.lit("source file not found")).alias("e")
    )
    if bad:
        broken = spark.createDataFrame(bad, "path string, e string")
        errors = errors.unionByName(
            broken.select(hour_of_path(F.col("path")).alias("hour"), F.concat_ws(": ", "e", "path").alias("e"))
        )
    errors = errors.filter(F.col("e").isNotNull()).groupBy("hour").agg(F.min("e").alias("error_message"))
    ok = todo.join(errors, "hour", "left_anti")

    counts = spark.createDataFrame([], "hour timestamp_ntz, rows_read bigint, rows_kept bigint, malformed_rows bigint")
    if rows is not None:
        counts = line_counters(rows, "hour").select("hour", "rows_read", "rows_kept", "malformed_rows")
        counts = written(counts, "counters")
        event_date, hour_text = partition_columns(F.col("hour"))
        kept = rows.filter(F.col("outcome") == KEPT)
        write_bronze(kept.select(*BRONZE.names, event_date, hour_text), bronze)
        if quarantine:
            lost = rows.filter(F.col("outcome") == MALFORMED)
            write_bronze(lost.select("source_file", "raw", event_date, hour_text), quarantine)
    done = ok.join(counts, "hour", "left")
    if force:
        empty = done.filter(F.coalesce("rows_kept", F.lit(0)) == 0).select("hour").collect()
        remove_folders(spark, [_partition_dir(bronze, r[0]) for r in empty])

    sizes = _written_bytes(spark, bronze, ok)
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    success = done.join(sizes, "hour", "left").select(
        "hour",
        F.lit("success").alias("status"),
        n("rows_read"),
        n("rows_kept"),
        n("malformed_rows"),
        n("bytes_written"),
        F.lit(None).cast("string").alias("error_message"),
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("rows_read", "rows_kept", "malformed_rows", "bytes_written")]
    failed = errors.select("hour", F.lit("failed").alias("status"), *zero, "error_message")
    skipped = wanted.join(todo, "hour", "left_anti").select(
        "hour", F.lit("skipped").alias("status"), *zero, F.lit(None).cast("string").alias("error_message")
    )
    # Fixed here: these rows must not be recomputed once the run log below has changed.
    outcomes = written(success.unionByName(failed).unionByName(skipped), "outcomes")
    finished = datetime.now(UTC).replace(tzinfo=None)
    append_runs(outcomes, run_log, batch=batch, started_at=started, finished_at=finished)
    return outcomes.orderBy("hour")


def parse_or_isolate(
    spark: SparkSession, paths: list[str], event_types: Sequence[str], stamp: datetime
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Parsed rows of all readable hours (None if there are none) and ``(path, error)`` of the rest.

    Files are not checked in advance. Only when reading fails are all files of the batch verified in
    one job, and the batch is repeated without the hours that have an unreadable file.
    """
    bad: list[tuple[str, str]] = []
    while paths:
        lines = read_lines(spark, paths).withColumn("hour", hour_of_path(F.col("source_file")))
        try:
            return written(classify_lines(lines, event_types, stamp), "parsed"), bad
        except Exception as e:
            if not _is_read_failure(e) or bad:
                raise
            bad = [(r["path"], r["error"]) for r in unreadable_files(spark, paths).collect()]
            if not bad:
                raise
            hours = spark.createDataFrame([(p,) for p in paths], "path string").withColumn(
                "hour", hour_of_path(F.col("path"))
            )
            lost = spark.createDataFrame(bad, "path string, e string").select(
                hour_of_path(F.col("path")).alias("hour")
            )
            paths = [r[0] for r in hours.join(lost, "hour", "left_anti").select("path").collect()]
    return None, bad


def _is_read_failure(e: Exception) -> bool:
    if isinstance(e, PySparkException) and (e.getCondition() or "").startswith("FAILED_READ_FILE"):
        return True
    return "FAILED_READ_FILE" in str(e)


def _partition_dir(root: str, hour: datetime) -> str:
    return f"{root}/event_date={hour:%Y-%m-%d}/hour={hour:%H}"


def _written_bytes(spark: SparkSession, bronze: str, hours: DataFrame) -> DataFrame:
    """Bytes per hour, listing only the days that these hours lie in."""
    days = hours.select(F.to_date("hour").alias("d")).distinct().collect()
    folders = [f"{bronze}/event_date={d:%Y-%m-%d}" for (d,) in days]
    folders = [p for p in folders if path_exists(spark, p)]
    if not folders:
        return spark.createDataFrame([], "hour timestamp_ntz, bytes_written bigint")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folders)
        .select(partition_hour(F.col("path")).alias("hour"), "length")
    )
    sizes = files.groupBy("hour").agg(F.sum("length").alias("bytes_written"))
    return sizes.join(hours, "hour", "left_semi")


def partition_hour(path: Column) -> Column:
    """The hour a bronze file path belongs to."""
    day = F.regexp_extract(path, r"event_date=(\d{4}-\d{2}-\d{2})", 1)
    hour = F.regexp_extract(path, r"/hour=(\d{2})", 1)
    return F.concat(day, F.lit(" "), hour, F.lit(":00:00")).try_cast("timestamp_ntz")


def run_log_rows(outcomes: DataFrame, batch: str, started_at: datetime, finished_at: datetime) -> DataFrame:
    """Run-log rows of the attempts in ``outcomes``; skipped hours are no attempts."""
    return outcomes.filter(F.col("status") != "skipped").select(
        F.md5(F.concat_ws("-", F.lit(batch), F.col("hour").cast("string"))).alias("run_id"),
        ntz(started_at).alias("started_at"),
        ntz(finished_at).alias("finished_at"),
        F.lit((finished_at - started_at).total_seconds()).alias("duration_s"),
        "status",
        F.col("hour").alias("hour_processed"),
        "rows_read",
        F.col("rows_kept").alias("rows_written"),
        "malformed_rows",
        "bytes_written",
        "error_message",
    )


def append_runs(
    outcomes: DataFrame, run_log: str, *, batch: str, started_at: datetime, finished_at: datetime
) -> None:
    append(run_log_rows(outcomes, batch, started_at, finished_at).coalesce(1), run_log)


def backfill_summary(outcomes: DataFrame) -> DataFrame:
    """Number of hours per status."""
    return outcomes.groupBy("status").agg(F.count("*").alias("hours"))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUN_LOG)


__all__ = [
    "append_runs",
    "backfill_summary",
    "classify_lines",
    "done_hours",
    "ingest_hours",
    "line_counters",
    "missing_hours",
    "parse_events",
    "parse_or_isolate",
    "partition_hour",
    "read_run_log",
    "run_log_rows",
    "unreadable_files",
]
