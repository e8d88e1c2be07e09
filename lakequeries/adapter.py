"""The driver's ``events`` table seen as the event feed (SQL twin: ``oracle.EV``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourlake.schemas import BRONZE, RUN_LOG
from hourlake.session import pin_utc

#: "Now" of every query, just after the last event, so that results do not depend on the clock.
NOW = datetime(2024, 1, 31)

# What each event type of the table stands for in the feed.
FEED_TYPE = {
    "signup": "PullRequestEvent",
    "purchase": "PullRequestEvent",
    "click": "PushEvent",
    "view": "WatchEvent",
    "error": "IssuesEvent",
}
ACTION = {"signup": "opened", "purchase": "merged"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        hit = F.col("t") == k
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out


#: Text after a line's object: it closes what a parser may have put around the line.
TAILS = ("]}", "]} x", ']},{"x":[1')


def third_of_month(ts: str) -> Column:
    """0, 1 or 2 (3 on the 31st): names change with it."""
    return F.floor((F.dayofmonth(ts) - 1) / 10)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze row per event: repositories come from ``props.k``, some are renamed over time."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("created_at"), "user_id", F.col("event_type").alias("t"), k.alias("k")
    )
    version = F.when(F.col("k") % 2 == 1, third_of_month("created_at")).otherwise(0)
    number = F.col("user_id").cast("int")
    name = F.concat(F.lit("\u00a0 Org"), F.col("k") % 7, F.lit("/Repo"), F.col("k"), F.lit("-"), version, F.lit(" "))
    login = F.concat(F.lit(" User"), F.col("user_id"), F.lit("-"), third_of_month("created_at"), F.lit(" "))
    hour = F.date_trunc("hour", "created_at").cast("timestamp_ntz")
    return e.select(
        "event_id",
        _mapped(FEED_TYPE).alias("event_type"),
        "created_at",
        F.col("user_id").alias("actor_id"),
        login.alias("actor_login"),
        F.col("k").alias("repo_id"),
        name.alias("repo_name"),
        (F.col("k") % 7).alias("org_id"),
        _mapped(ACTION).alias("action"),
        F.when(F.col("t").isin(*ACTION), number).alias("pr_number"),
        F.when(F.col("t") == "error", number).alias("issue_number"),
        (hour + F.expr("INTERVAL 2 HOUR")).alias("ingested_at"),
        source_file(F.col("created_at")).alias("source_file"),
    ).select(*BRONZE.names)


def source_file(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd-"), F.hour(ts).cast("string"), F.lit(".json.gz"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with issue events delivered twice; the later copy carries a corrected login."""
    first = feed(spark, sf_dir)
    again = first.filter(F.col("event_type") == "IssuesEvent").withColumns(
        {
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
            "actor_login": F.concat(F.lit("Fixed"), F.col("actor_id")),
        }
    )
    return first.unionByName(again)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one logged run; errors are the failed ones."""
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.col("value") * F.expr("INTERVAL '1' SECOND")).alias("finished_at"),
        F.col("value").alias("duration_s"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_processed"),
        (F.col("event_id") + 10).alias("rows_read"),
        F.when(failed, F.lit(0)).otherwise(F.col("event_id")).cast("bigint").alias("rows_written"),
        F.lit(10).cast("bigint").alias("malformed_rows"),
        (F.col("user_id") * 100).alias("bytes_written"),
        F.when(failed, F.col("props")).alias("error_message"),
    ).select(*RUN_LOG.names)


def whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as well-formed raw text ``(value, source_file)``; pushes carry an offset of +05:30."""
    return _lines(feed(spark, sf_dir)).select("value", "source_file")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``whole_lines``, with faults: issue events are cut short or have text after the object, in four
    ways (all malformed), and every pull-request opening is followed by a blank line.
    """
    lines = _lines(feed(spark, sf_dir))
    cut = F.substring("value", 1, F.length("value") - 1)
    way = F.col("event_id") % 4
    for k, tail in enumerate(TAILS):
        cut = F.when(way == k + 1, F.concat("value", F.lit(tail))).otherwise(cut)
    text = F.when(F.col("event_type") == "IssuesEvent", cut).otherwise(F.col("value"))
    opened = F.coalesce(F.col("action") == "opened", F.lit(False))
    texts = F.when(opened, F.array(text, F.lit("  \t"))).otherwise(F.array(text))
    return lines.select(F.explode(texts).alias("value"), "source_file")


def _lines(ev: DataFrame) -> DataFrame:
    # The table may be one file; the feed's lines come from many. As many tasks as a shuffle has.
    ev = ev.repartition("event_id")
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    push = F.col("event_type") == "PushEvent"
    local = F.date_format(F.col("created_at") + F.expr("INTERVAL '05:30' HOUR TO MINUTE"), pattern)
    stamp = F.when(push, F.concat(local, F.lit("+05:30"))).otherwise(
        F.concat(F.date_format("created_at", pattern), F.lit("Z"))
    )
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("type"),
            stamp.alias("created_at"),
            F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
            F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
            F.struct(F.col("org_id").alias("id")).alias("org"),
            F.struct(
                "action",
                F.when(F.col("pr_number").isNotNull(), F.struct(F.col("pr_number").alias("number"))).alias("pull_request"),
                F.when(F.col("issue_number").isNotNull(), F.struct(F.col("issue_number").alias("number"))).alias("issue"),
            ).alias("payload"),
        )
    )
    return ev.select(line.alias("value"), "source_file", "event_type", "action", "event_id")


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file with this content, wherever the session's file systems put it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath)
    out.write(bytearray(data))
    out.close()


def land(lines: DataFrame, landing: str) -> None:
    """Write raw lines as gzip parts of even size, in folders named after the hour."""
    (
        lines.hint("rebalance", "source_file")
        .withColumnRenamed("source_file", "hour_file")
        .write.partitionBy("hour_file")
        .option("compression", "gzip")
        .text(landing)
    )
