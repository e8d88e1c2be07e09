"""One entry per operator: ``name -> (spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
import gzip
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourlake.functions import conform_name, date_key, elapsed_hours, event_date, event_hour, iso_to_utc, name_part, surrogate_key
from hourlake.operators import checks, profile, retention
from hourlake.operators.asof import point_in_time_join
from hourlake.operators.calendar import dim_date
from hourlake.operators.dedupe import latest_per_key, latest_value
from hourlake.operators.pairing import open_merge_pairs
from hourlake.operators.percentiles import grouped_percentiles
from hourlake.operators.scd import scd1_upsert, scd2_from_history
from hourlake.operators.upsert import batches, newer_than, replace_partitions, unconsumed, upsert, upsert_table
from hourlake.plans.build import LakePaths, build
from hourlake.plans import analytics, gold, health, ingest, marts, quality, silver
from hourlake.schemas import BRONZE, FACT_EVENTS
from hourlake.sources.bronze import partition_columns, read_bronze, write_bronze
from hourlake.sources.files import footprint, list_files, read_or_empty
from hourlake.sources.landing import HOUR_NAME, hour_name, hour_of_path, hour_path, hour_range, read_lines
from hourlake.sources.manifest import current
from hourlake.sources.scratch import scratch_path, written
from hourlake.sources.seeds import event_types
from hourlake.sources.tables import append, compacted, publish, published
from hourlake.streaming import (
    dedupe_stream,
    hourly_volume_stream,
    late_rows,
    recovered_volume,
    stored_volume,
    stream_to_bronze,
    upsert_stream,
    volume_and_late_rows,
    volume_to_table,
)
from lakequeries import adapter
from lakequeries.adapter import NOW, bronze, feed, raw_lines, runs, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The middle of the month splits "already there" from "arriving" in the incremental queries.
SPLIT = datetime(2024, 1, 16)
FIRST, LAST = date(2024, 1, 6), date(2024, 1, 25)
KEPT_TYPES = ("PullRequestEvent", "PushEvent", "IssuesEvent")
BATCH_TS = datetime(2024, 2, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _before(df: DataFrame, when: datetime, col: str = "created_at") -> DataFrame:
    return df.filter(F.col(col) < F.lit(when.isoformat(" ")).cast("timestamp_ntz"))


def _from(df: DataFrame, when: datetime, col: str = "created_at") -> DataFrame:
    return df.filter(F.col(col) >= F.lit(when.isoformat(" ")).cast("timestamp_ntz"))


def _events(spark, sf) -> DataFrame:
    return silver.stg_events(bronze(spark, sf))


def _history(ev: DataFrame) -> DataFrame:
    return gold.with_repo_keys(gold.dim_repo_history(ev))


def _fact(spark, sf, strategy="auto") -> DataFrame:
    # Silver is a published table in the lake; here it is written once and read by each consumer.
    ev = written(_events(spark, sf), "silver")
    return gold.fact_events(ev, _history(ev), gold.opened_prs(ev), strategy)


def _feed_fact(spark, sf) -> DataFrame:
    """Fact columns that need no join, straight from the feed."""
    ev = feed(spark, sf)
    return ev.withColumns(
        {
            "date_key": date_key("created_at"),
            "event_type_key": surrogate_key("event_type"),
            "actor_key": surrogate_key("actor_id"),
            "is_pr_merged": gold.is_merged(),
        }
    )


def _activity(spark, sf) -> DataFrame:
    return marts.daily_repo_activity(_feed_fact(spark, sf), dim_date(spark), gold.dim_event_type(spark))


def _volume(spark, sf) -> DataFrame:
    return marts.hourly_volume(_feed_fact(spark, sf))


def _named(spark, sf) -> DataFrame:
    return analytics.activity_named(_activity(spark, sf), dim_date(spark), _history(_silver_like(feed(spark, sf))))


def _silver_like(ev: DataFrame) -> DataFrame:
    """Names conformed as in silver, for inputs that hold no duplicates."""
    name = conform_name("repo_name")
    return ev.withColumn("repo_name", name).withColumns(
        {
            "repo_owner": name_part("repo_name", 1),
            "repo_short_name": name_part("repo_name", 2),
            "event_date": event_date("created_at"),
        }
    )


def _lifecycle(spark, sf) -> DataFrame:
    pairs = gold.pr_lifecycle(feed(spark, sf))
    fact = pairs.select(
        "repo_id",
        "pr_number",
        F.col("merged_at").alias("created_at"),
        "hours_to_merge",
        F.lit(True).alias("is_pr_merged"),
    )
    return marts.pr_lifecycle_mart(fact)


def _bronze_on_disk(spark, sf) -> str:
    root = scratch_path(spark, "bronze")
    rows = feed(spark, sf)
    day, hour = partition_columns(hour_of_path(F.col("source_file")))
    write_bronze(rows.select("*", day, hour).hint("rebalance", "event_date", "hour"), root)
    return root


def _landing(spark, sf) -> str:
    root = scratch_path(spark, "landing")
    adapter.land(raw_lines(spark, sf), root)
    return root


# -- sources and sinks --------------------------------------------------------------------------


@query
def s01_hourly_ndjson_scan(spark, sf):
    landing = _landing(spark, sf)
    hours = [r[0] for r in i11_hour_range(spark, sf).collect()]
    paths = [p for p in (hour_path(spark, landing, h) for h in hours) if p]
    lines = read_lines(spark, paths)
    return lines.groupBy(hour_of_path(F.col("source_file")).alias("hour")).agg(F.count("*").alias("lines"))


@query
def s02_bronze_partition_sink(spark, sf):
    root = _bronze_on_disk(spark, sf)
    # Writing part of it again must replace partitions, not add to them.
    again = read_bronze(spark, root).filter(F.col("event_date") >= F.lit(SPLIT.date()))
    write_bronze(written(again, "again"), root)
    return (
        read_bronze(spark, root)
        .groupBy("event_date", "hour")
        .agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.countDistinct("actor_id").alias("actors"))
    )


@query
def s03_bronze_scan(spark, sf):
    return read_bronze(spark, _bronze_on_disk(spark, sf))


@query
def s04_seed_lookup(spark, sf):
    counts = feed(spark, sf).groupBy("event_type").agg(F.count("*").alias("n"))
    return F.broadcast(event_types(spark)).join(counts, "event_type", "left").select(
        "event_type", "description", "category", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def s05_table_publish(spark, sf):
    path = scratch_path(spark, "published")
    volume = _volume(spark, sf)
    publish(volume.filter(F.col("event_hour") < 12), path)
    # The second version is built from the first one and replaces it.
    first = published(spark, path, volume.schema)
    publish(first.unionByName(volume.filter(F.col("event_hour") >= 12)), path)
    return published(spark, path, volume.schema)


@query
def s06_run_log_append(spark, sf):
    path = scratch_path(spark, "runs")
    log = runs(spark, sf)
    append(_before(log, SPLIT, "started_at"), path)
    append(_from(log, SPLIT, "started_at"), path)
    both = read_or_empty(spark, path, log.schema)
    done = scratch_path(spark, "runs-compact")
    publish(compacted(both), done)
    return published(spark, done, log.schema)


@query
def s07_read_or_empty(spark, sf):
    nothing = read_or_empty(spark, scratch_path(spark, "absent"), BRONZE)
    return feed(spark, sf).unionByName(nothing).groupBy("event_type").agg(F.count("*").alias("n"))


@query
def s08_partition_listing(spark, sf):
    files = list_files(spark, _bronze_on_disk(spark, sf), "*.parquet")
    return files.groupBy(ingest.partition_hour(F.col("path")).alias("hour")).agg(
        (F.count("*") > 0).alias("has_files"), (F.min("length") > 0).alias("has_bytes")
    )


# -- ingest -------------------------------------------------------------------------------------


@query
def i01_blank_lines(spark, sf):
    lines = raw_lines(spark, sf)
    read = ingest.classify_lines(lines, KEPT_TYPES, BATCH_TS).agg(F.count("*").alias("n")).scalar()
    return lines.agg(F.count("*").alias("lines"), read.alias("rows_read"))


@query
def i02_malformed_lines(spark, sf):
    rows = ingest.classify_lines(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS)
    bad = rows.filter(F.col("outcome") == ingest.MALFORMED)
    return bad.groupBy("source_file").agg(F.count("*").alias("malformed_rows"))


@query
def i03_type_filter(spark, sf):
    rows = ingest.classify_lines(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS)
    parsed = rows.filter(F.col("event_type").isNotNull())
    return parsed.groupBy("event_type", "outcome").agg(F.count("*").alias("n"))


@query
def i04_flatten(spark, sf):
    good, _ = ingest.parse_events(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS)
    return good


@query
def i05_quarantine(spark, sf):
    _, bad = ingest.parse_events(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS)
    return bad.select("source_file", F.length("raw").cast("bigint").alias("raw_length"))


@query
def i06_timestamp_normalisation(spark, sf):
    o = table(spark, sf, "orders")
    text = F.concat(
        F.date_format(F.col("o_orderdate") - F.expr("INTERVAL '03:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("-03:30"),
    )
    return o.select("o_orderkey", iso_to_utc(text).alias("placed_at"))


@query
def i07_lineage(spark, sf):
    good, _ = ingest.parse_events(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS)
    return good.groupBy("source_file", "ingested_at").agg(F.count("*").alias("n"))


@query
def i08_line_counters(spark, sf):
    return ingest.line_counters(ingest.classify_lines(raw_lines(spark, sf), KEPT_TYPES, BATCH_TS))


@query
def i09_idempotent_skip(spark, sf):
    """The same hours twice: the second time those that were found are skipped."""
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    hours = i11_hour_range(spark, sf)
    for _ in range(2):
        last = ingest.ingest_hours(spark, landing, out, log, hours, event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    return ingest.backfill_summary(last)


@query
def i14_unreadable_files(spark, sf):
    """The feed and three more hours: one is no gzip, one is cut short, one is missing."""
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    march = datetime(2024, 3, 1)
    for k, data in enumerate((b"no gzip", gzip.compress(b"{}" * 5000)[:-9])):
        adapter.put_bytes(spark, f"{landing}/{hour_name(march.replace(hour=k))}", data)
    hours = i11_hour_range(spark, sf).unionByName(hour_range(spark, march, march.replace(hour=2)))
    out = ingest.ingest_hours(spark, landing, out, log, hours, event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    error = F.regexp_extract(F.coalesce("error_message", F.lit("")), "^[a-z ]*", 0).alias("error")
    return out.groupBy("status", error).agg(F.count("*").alias("hours"))


@query
def i10_force_reingest(spark, sf):
    """Everything ingested, then everything again by force: replaced, not added."""
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    hours = i11_hour_range(spark, sf)
    ingest.ingest_hours(spark, landing, out, log, hours, event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    last = ingest.ingest_hours(
        spark, landing, out, log, hours, event_types=KEPT_TYPES, ingested_at=NOW, force=True
    )
    stored = read_bronze(spark, out).agg(F.count("*").alias("n"), F.min("ingested_at").alias("stamp"))
    return last.groupBy("status").agg(F.sum("rows_kept").alias("rows_kept")).select(
        "status", "rows_kept", stored.select("n").scalar().alias("stored"), stored.select("stamp").scalar().alias("stamp")
    )


@query
def i11_hour_range(spark, sf):
    e = table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    whole = [t.replace(minute=0, second=0, microsecond=0) for t in e]
    return hour_range(spark, *whole)


@query
def i12_backfill(spark, sf):
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    hours = i11_hour_range(spark, sf)
    args = dict(event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    ingest.ingest_hours(spark, landing, out, log, _before(hours, SPLIT, "hour"), **args)
    # The whole range again: done hours are skipped, the rest is caught up.
    ingest.ingest_hours(spark, landing, out, log, hours, **args)
    return read_bronze(spark, out).select(*[c for c in BRONZE.names if c != "source_file"], "event_date", "hour")


@query
def i13_missing_hours(spark, sf):
    bought = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    done = bought.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).distinct()
    return ingest.missing_hours(i11_hour_range(spark, sf), done)


@query
def i15_run_log_rows(spark, sf):
    log = runs(spark, sf)
    outcomes = log.select(
        F.col("hour_processed").alias("hour"),
        "status",
        "rows_read",
        F.col("rows_written").alias("rows_kept"),
        "malformed_rows",
        "bytes_written",
        "error_message",
    )
    rows = ingest.run_log_rows(outcomes, "batch", datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 0, 30))
    return rows.drop("bytes_written")


@query
def i16_backfill_summary(spark, sf):
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    hours = i11_hour_range(spark, sf)
    args = dict(event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    ingest.ingest_hours(spark, landing, out, log, _before(hours, SPLIT, "hour"), **args)
    wanted = hours.unionByName(
        hour_range(spark, datetime(2024, 3, 1), datetime(2024, 3, 1, 4))
    )
    return ingest.backfill_summary(ingest.ingest_hours(spark, landing, out, log, wanted, **args))


# -- silver -------------------------------------------------------------------------------------


@query
def v01_dedupe_latest(spark, sf):
    return latest_per_key(bronze(spark, sf), ["event_id"], ["ingested_at"])


@query
def v01_latest_shipment(spark, sf):
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate"], ["l_linenumber"])


@query
def v02_conform_names(spark, sf):
    p = table(spark, sf, "part")
    name = conform_name(F.concat(F.lit("  "), "p_brand", F.lit("/"), "p_name", F.lit("  ")))
    return p.select("p_partkey", name.alias("name"))


@query
def v03_split_name(spark, sf):
    p = table(spark, sf, "part")
    # Three shapes: owner/name/rest, no slash at all, and NULL.
    raw = (
        F.when(F.col("p_type") == "ECONOMY", F.concat_ws("/", "p_brand", "p_name", "p_type"))
        .when(F.col("p_type") == "SMALL", F.col("p_name"))
    )
    return p.select("p_partkey", name_part(raw, 1).alias("owner"), name_part(raw, 2).alias("short_name"))


@query
def v04_date_hour(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", event_date("ts").alias("event_date"), event_hour("ts").alias("event_hour"))


@query
def v05_daily_latest(spark, sf):
    return silver.stg_repos(_silver_like(feed(spark, sf)))


@query
def v06_latest_per_key(spark, sf):
    return silver.stg_actors(feed(spark, sf))


@query
def v07_stg_events(spark, sf):
    return _events(spark, sf)


# -- gold ---------------------------------------------------------------------------------------


@query
def g01_surrogate_key(spark, sf):
    o = table(spark, sf, "orders")
    missing = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return o.select(
        "o_orderkey",
        surrogate_key("o_custkey").alias("one_field"),
        surrogate_key("o_orderkey", "o_orderdate", missing).alias("three_fields"),
    )


@query
def g02_scd2_history(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return scd2_from_history(e, "user_id", ["event_type"], "ts", ["event_id"]).drop("event_id")


@query
def g02_scd2_snapshot(spark, sf):
    """A scheduled snapshot after every ten days of the whole range, each seeing these days."""
    repos = silver.stg_repos(_silver_like(feed(spark, sf)))
    repos = written(repos, "repos")
    never = F.lit(None).cast("timestamp_ntz")
    none = repos.limit(0).select("repo_id", *gold.REPO_ATTRIBUTES)
    versions = none.withColumns({"valid_from": never, "valid_to": never})
    start, last = repos.agg(F.min("event_date"), F.max("event_date")).first()
    while start is not None and start <= last:
        run = start + timedelta(days=10)
        seen = repos.filter((F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(run)))
        # each run publishes its state, and the next one starts from there
        versions = written(gold.dim_repo_snapshot(seen, versions, datetime(run.year, run.month, run.day)), "snapshot")
        start = run
    return versions


@query
def g03_current_per_repo(spark, sf):
    return gold.repo_current(silver.stg_repos(_silver_like(feed(spark, sf))))


@query
def g04_scd2_dimension(spark, sf):
    return _history(_silver_like(feed(spark, sf)))


@query
def g04_scd2_current(spark, sf):
    return _history(_silver_like(feed(spark, sf))).filter("is_current").select("repo_id", "repo_name", "valid_from")


@query
def g05_scd1_upsert(spark, sf):
    ev = feed(spark, sf)
    old = gold.dim_actor(silver.stg_actors(_before(ev, SPLIT)))
    return gold.dim_actor(silver.stg_actors(_from(ev, SPLIT)), old)


@query
def g06_calendar(spark, sf):
    days = table(spark, sf, "orders").groupBy(date_key("o_orderdate").alias("date_key")).agg(F.count("*").alias("orders"))
    return dim_date(spark).join(days, "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def _actor_versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "events")
    versions = g02_scd2_history(spark, sf).withColumnRenamed("event_type", "state")
    return e.select("event_id", "user_id", "ts"), versions


@query
def g07_point_in_time_join(spark, sf):
    fact, versions = _actor_versions(spark, sf)
    return point_in_time_join(fact, versions, "user_id", "ts", strategy="range")


@query
def g07b_asof_window(spark, sf):
    fact, versions = _actor_versions(spark, sf)
    return point_in_time_join(fact, versions, "user_id", "ts", strategy="window")


@query
def g07c_asof_unmatched(spark, sf):
    """Orders against the versions of users: most match nothing and stay, with NULLs."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), "o_orderdate")
    _, versions = _actor_versions(spark, sf)
    return point_in_time_join(o, versions, "user_id", "o_orderdate", strategy="window")


@query
def g08_incremental_filter(spark, sf):
    ev = bronze(spark, sf)
    stored = _before(ev, SPLIT, "ingested_at")
    return newer_than(ev, stored)


@query
def g08b_unconsumed_batches(spark, sf):
    ev = bronze(spark, sf)
    ledger = batches(_before(ev, SPLIT))
    return unconsumed(ev, ledger).select(*BRONZE.names)


@query
def g09_upsert(spark, sf):
    ev = bronze(spark, sf)
    stored = latest_per_key(_before(ev, SPLIT, "ingested_at"), ["event_id"], ["ingested_at"])
    news = latest_per_key(_from(ev, SPLIT, "ingested_at"), ["event_id"], ["ingested_at"])
    return upsert(stored, news, ["event_id"])


@query
def g09b_upsert_table(spark, sf):
    """Through the partitioned table; corrected events move to the next day's partition."""
    path = scratch_path(spark, "fact")
    ev = bronze(spark, sf).select(
        "event_id", "actor_login", "ingested_at", date_key("ingested_at").alias("date_key")
    )
    schema = ev.schema
    for part in (_before(ev, SPLIT, "ingested_at"), _from(ev, SPLIT, "ingested_at")):
        latest = latest_per_key(part, ["event_id"], ["ingested_at"])
        upsert_table(spark, path, latest, ["event_id"], "date_key", schema)
    return current(spark, path, schema)


@query
def g10_fact_events(spark, sf):
    return _fact(spark, sf)


@query
def g10b_fact_events_window(spark, sf):
    return _fact(spark, sf, "window")


@query
def g10c_fact_late_batches(spark, sf):
    """The lake built in three steps whose batches come in shuffled order: late hours change versions and openings."""
    lake = LakePaths(scratch_path(spark, "lake"))
    day, hour = partition_columns(hour_of_path(F.col("source_file")))
    rows = bronze(spark, sf).select("*", day, hour)
    # A corrected copy lands with its hour, in a file of its own.
    rows = rows.withColumn("source_file", F.concat_ws("#", "source_file", "ingested_at"))
    for k in (2, 0, 1):
        part = rows.filter(F.pmod(F.xxhash64("event_date", "hour"), F.lit(3)) == k)
        write_bronze(part.hint("rebalance", "event_date", "hour"), lake.bronze)
        try:
            build(spark, lake, NOW, f"step{k}")
        except checks.ChecksFailed:
            pass  # the feed has merges before openings; the fact is complete nevertheless
    return current(spark, lake.gold("fact_events"), FACT_EVENTS)


@query
def g11_open_merge_pairs(spark, sf):
    return gold.pr_lifecycle(feed(spark, sf))


@query
def g11b_first_merge(spark, sf):
    return gold.pr_lifecycle(feed(spark, sf), merge_pick="first")


@query
def g12_elapsed_hours(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", F.round(elapsed_hours("o_orderdate", "l_shipdate"), 6).alias("hours"))


@query
def g13_merge_flag(spark, sf):
    return feed(spark, sf).select("event_id", gold.is_merged().alias("is_pr_merged"))


@query
def g14_event_type_dimension(spark, sf):
    used = feed(spark, sf).groupBy("event_type").agg(F.count("*").alias("events"))
    return gold.dim_event_type(spark).join(used, "event_type", "left").select(
        "event_type_key", "event_type", "description", "category", F.coalesce("events", F.lit(0)).alias("events")
    )


@query
def g15_date_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy(date_key("l_shipdate").alias("date_key")).agg(F.count("*").alias("n"))


# -- marts --------------------------------------------------------------------------------------


@query
def m01_daily_activity(spark, sf):
    return _activity(spark, sf)


@query
def m01b_activity_from_fact(spark, sf):
    return marts.daily_repo_activity(_fact(spark, sf), dim_date(spark), gold.dim_event_type(spark))


def _by_day(spark, rows: DataFrame, daily: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """A stored table of per-day states: without every second day's last rows at first, then these days are replaced."""
    path = scratch_path(spark, "daily")
    days = sorted(r[0] for r in rows.select("date_key").distinct().collect())
    late = F.col("date_key").isin(days[::2]) & (F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == 0)
    replace_partitions(daily(rows.filter(~late)), path, "date_key", days)
    replace_partitions(daily(rows.filter(F.col("date_key").isin(days[::2]))), path, "date_key", days[::2])
    return current(spark, path, schema)


def _contributors(spark, sf, unit: str) -> DataFrame:
    types = gold.dim_event_type(spark)
    daily = _by_day(spark, _feed_fact(spark, sf), lambda rows: marts.daily_contributors(rows, types), marts.CONTRIBUTORS)
    return marts.contributors(daily, unit)


@query
def m01c_weekly_contributors(spark, sf):
    return _contributors(spark, sf, "week")


@query
def m01d_monthly_contributors(spark, sf):
    return _contributors(spark, sf, "month")


@query
def m02_lifecycle_percentiles(spark, sf):
    d = _lifecycle(spark, sf)
    return d.withColumns({c: F.round(c, 6) for c in d.columns if "hours" in c})


@query
def m02c_percentiles_by_day(spark, sf):
    """Percentiles of the merges from stored counts per day, every second of which was counted twice."""
    merges = gold.pr_lifecycle(feed(spark, sf)).select("repo_id", "hours_to_merge", date_key("merged_at").alias("date_key"))
    daily = _by_day(spark, written(merges.withColumn("is_pr_merged", F.lit(True)), "merges"), marts.daily_paces, marts.PACES)
    d = marts.repo_paces(daily)
    return d.withColumns({c: F.round(c, 6) for c in d.columns if "hours" in c})


@query
def m02b_line_price_percentiles(spark, sf):
    l = table(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100)
    p = grouped_percentiles(l, ["l_returnflag", "l_linestatus"], cents, 100.0, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return p.withColumns({c: F.round(c, 4) for c in ("p50", "p95", "p99")})


@query
def m03_back_derived_start(spark, sf):
    """Opening times recomputed from the merge time and the whole-second duration."""
    return _lifecycle(spark, sf).select("repo_id", "pr_number", "opened_at", "merged_at")


@query
def m04_hourly_volume(spark, sf):
    return _volume(spark, sf)


@query
def m05_health_snapshot(spark, sf):
    d = health.pipeline_health(runs(spark, sf), feed(spark, sf), NOW)
    rates = ("success_rate_24h", "success_rate_7d", "p50_duration_s", "p95_duration_s", "data_age_hours")
    return d.withColumns({c: F.round(c, 6) for c in rates})


@query
def m06_run_rates(spark, sf):
    d = health.run_rates(runs(spark, sf), datetime(2024, 1, 20, 12))
    return d.withColumns({c: F.round(c, 6) for c in ("success_rate_24h", "success_rate_7d")})


@query
def m07_duration_percentiles(spark, sf):
    d = health.duration_percentiles(runs(spark, sf))
    return d.withColumns({c: F.round(c, 6) for c in d.columns})


@query
def m07b_durations_by_day(spark, sf):
    rows = runs(spark, sf).withColumn("date_key", date_key("started_at"))
    d = health.merged_duration_percentiles(_by_day(spark, rows, health.daily_durations, health.DURATIONS))
    return d.withColumns({c: F.round(c, 6) for c in d.columns})


@query
def m08_failure_streak(spark, sf):
    return health.failure_streak(runs(spark, sf))


@query
def m08b_long_streak(spark, sf):
    """Every run from the middle of the month on has failed."""
    middle = F.lit(SPLIT.isoformat(" ")).cast("timestamp_ntz")
    status = F.when(F.col("started_at") < middle, F.col("status")).otherwise("failed")
    return health.failure_streak(runs(spark, sf).withColumn("status", status))


@query
def m09_data_age(spark, sf):
    d = health.data_age(feed(spark, sf), NOW)
    return d.withColumn("data_age_hours", F.round("data_age_hours", 6))


# -- checks -------------------------------------------------------------------------------------


@query
def q01_unique(spark, sf):
    return checks.not_unique(table(spark, sf, "lineitem"), "l_orderkey")


@query
def q02_not_null(spark, sf):
    """NULL counts of all feed columns in one scan."""
    suite = [checks.not_null("feed", c) for c in BRONZE.names]
    out = checks.run_checks(suite, {"feed": feed(spark, sf)})
    return out.select("unique_id", "violations", "status")


@query
def q03_accepted_values(spark, sf):
    return checks.unexpected_values(feed(spark, sf), "event_type", ["PushEvent", "WatchEvent"])


@query
def q04_relationships(spark, sf):
    return checks.orphans(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"), "user_id")


@query
def q05_unique_combination(spark, sf):
    return checks.not_unique(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", "l_linestatus")


@query
def q06_no_future_events(spark, sf):
    ev = feed(spark, sf)
    return ev.filter(quality.future_event(datetime(2024, 1, 30, 12))).select("event_id", "created_at")


@query
def q07_merge_after_open(spark, sf):
    return gold.pr_lifecycle(feed(spark, sf)).filter(quality.merged_before_opened())


@query
def q08_anomaly(spark, sf):
    d = quality.volume_anomalies(_volume(spark, sf), dim_date(spark))
    return d.withColumns({c: F.round(c, 6) for c in ("mean_count", "stddev_count")})


@query
def q08b_anomaly_filled(spark, sf):
    d = quality.volume_anomalies(_volume(spark, sf), dim_date(spark), sigmas=1.0, fill_missing=True)
    return d.withColumns({c: F.round(c, 6) for c in ("mean_count", "stddev_count")})


@query
def q09_severity(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer", "events")}
    suite = [
        checks.unique("orders", "o_orderkey"),
        checks.unique("lineitem", "l_orderkey", severity=checks.WARN),
        checks.unique("events", "user_id"),
        checks.not_null("orders", "o_custkey"),
        checks.accepted_values("orders", "o_orderstatus", ["F", "O"], severity=checks.WARN),
        checks.accepted_values("events", "event_type", list(adapter.FEED_TYPE)),
        checks.relationships("orders", "o_custkey", "customer", "c_custkey"),
        checks.relationships("events", "user_id", "orders", "o_custkey", severity=checks.WARN),
    ]
    return checks.run_checks(suite, tables)


@query
def q09b_checks_by_day(spark, sf):
    """Row-level checks from stored violations per day, every second of which was looked at twice."""
    fact = _feed_fact(spark, sf)
    suite = [
        checks.not_null("feed", "pr_number", severity=checks.WARN),
        checks.not_null("feed", "repo_id"),
        checks.accepted_values("feed", "event_type", ("PushEvent", "WatchEvent")),
        checks.row_check("no_late_hours", "feed", F.hour("created_at") >= 22),
    ]
    daily = _by_day(spark, fact, lambda rows: checks.row_states(suite, "feed", rows, "date_key"), f"{checks.STATES}, date_key int")
    return checks.run_checks(suite, {"feed": fact}, {"feed": daily})


@query
def q10_summary(spark, sf):
    status = (
        F.when(F.col("event_type").isin("click", "view"), "pass")
        .when(F.col("event_type") == "signup", "warn")
        .when(F.col("event_type") == "purchase", "fail")
        .otherwise("error")
    )
    tests = table(spark, sf, "events").select(
        F.concat(F.lit("test."), F.col("event_id")).alias("unique_id"), status.alias("status")
    )
    models = table(spark, sf, "orders").select(
        F.concat(F.lit("model."), F.col("o_orderkey")).alias("unique_id"), F.lit("error").alias("status")
    )
    return checks.summarise(tests.unionByName(models), NOW, "run")


@query
def q10b_declared_checks(spark, sf):
    """The declared suite over the lake's tables, all made from the feed."""
    t = {"stg_events": written(_events(spark, sf), "silver"), "pipeline_runs": runs(spark, sf)}
    ev = t["stg_events"]
    t["stg_repos"], t["stg_actors"] = silver.stg_repos(ev), silver.stg_actors(ev)
    t["dim_date"], t["dim_event_type"] = dim_date(spark), gold.dim_event_type(spark)
    t["dim_actor"], t["dim_repo"] = gold.dim_actor(t["stg_actors"]), written(_history(ev), "repos")
    t["pr_lifecycle"] = written(gold.pr_lifecycle(ev), "pairs")
    t["fact_events"] = fact = written(gold.fact_events(ev, t["dim_repo"], gold.opened_prs(ev)), "fact")
    t["mart_daily_repo_activity"] = marts.daily_repo_activity(fact, t["dim_date"], t["dim_event_type"])
    t["mart_hourly_volume"] = marts.hourly_volume(fact)
    t["mart_pr_lifecycle"] = marts.pr_lifecycle_mart(fact)
    t["mart_pipeline_health"] = health.pipeline_health(t["pipeline_runs"], fact, NOW)
    return checks.run_checks(quality.default_checks(NOW), t)


@query
def q11_freshness(spark, sf):
    d = quality.freshness(feed(spark, sf), NOW, 3)
    return d.withColumn("age_hours", F.round("age_hours", 6))


@query
def q12_band(spark, sf):
    """Freshness per repository, in bands."""
    age = (F.unix_micros(F.lit(NOW.isoformat(" ")).cast("timestamp")) - F.unix_micros(F.max("created_at").cast("timestamp"))) / 3.6e9
    per_repo = feed(spark, sf).groupBy("repo_id").agg(age.alias("age"))
    return per_repo.select("repo_id", quality.freshness_band(F.col("age"), F.lit(6.0)).alias("band"))


@query
def q13_failure_report(spark, sf):
    return quality.failure_report(runs(spark, sf), "ingest", "run/")


# -- retention and footprint --------------------------------------------------------------------

TODAY, DAYS = date(2024, 1, 31), 7


def _expired(spark, sf) -> DataFrame:
    return retention.expired_partitions(list_files(spark, _bronze_on_disk(spark, sf), "*.parquet"), TODAY, DAYS)


@query
def r01_expired_partitions(spark, sf):
    return _expired(spark, sf).select("event_date", (F.col("files") > 0).alias("has_files"))


@query
def r02_reclaimable(spark, sf):
    out = retention.reclaimable(_expired(spark, sf), TODAY, DAYS)
    return out.withColumns({c: F.col(c) > 0 for c in ("bytes_reclaimable", "files_expired")})


@query
def r03_retained(spark, sf):
    kept = retention.retained(read_bronze(spark, _bronze_on_disk(spark, sf)), TODAY, DAYS)
    return kept.groupBy("event_date").agg(F.count("*").alias("n"))


@query
def r04_footprint(spark, sf):
    sizes = footprint(spark, {"bronze": _bronze_on_disk(spark, sf), "tables": sf, "none": scratch_path(spark, "none")})
    return sizes.select("zone", *[(F.col(c) > 0).alias(n) for c, n in (("file_count", "has_files"), ("bytes", "has_bytes"), ("mb", "has_mb"))])


# -- analytics ----------------------------------------------------------------------------------


@query
def a01_activity_named(spark, sf):
    return _named(spark, sf)


@query
def a02_hourly_series(spark, sf):
    return analytics.hourly_series(_volume(spark, sf), dim_date(spark), FIRST, LAST)


@query
def a03_filtered(spark, sf):
    return analytics.activity_filtered(_named(spark, sf), FIRST, LAST, ["code", "social"])


@query
def a04_top20(spark, sf):
    return analytics.top_repos(_named(spark, sf))


@query
def a05_histogram(spark, sf):
    mart = written(_lifecycle(spark, sf), "lifecycle")
    d = analytics.merge_time_histogram(mart, FIRST, LAST)
    return d.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query
def a06_weekend_split(spark, sf):
    return analytics.weekend_split(_named(spark, sf))


@query
def a07_latest48(spark, sf):
    return analytics.latest_runs(runs(spark, sf))


@query
def a08_latest_check_result(spark, sf):
    """One summary per day (events as checks); the last one is reported."""
    daily = table(spark, sf, "events").groupBy(event_date("ts").alias("d")).agg(
        F.count("*").alias("total_tests"),
        F.count_if(F.col("event_type") != "error").alias("passed_tests"),
        F.lit(0).cast("bigint").alias("warned_tests"),
        F.count_if(F.col("event_type") == "error").alias("failed_tests"),
    )
    results = daily.select(
        F.col("d").cast("string").alias("run_id"), F.col("d").cast("timestamp_ntz").alias("recorded_at"), "*"
    ).drop("d")
    out = analytics.latest_check_result(results)
    return out.withColumn("pass_rate", F.round("pass_rate", 6))


@query
def a09_filter_choices(spark, sf):
    out = analytics.filter_choices(_activity(spark, sf))
    return out.withColumn("categories", F.array_join("categories", ","))


# -- profiling ----------------------------------------------------------------------------------


@query
def p01_type_distribution(spark, sf):
    d = profile.type_distribution(adapter.whole_lines(spark, sf))
    return d.withColumn("pct", F.round("pct", 6))


@query
def p02_schema_tree(spark, sf):
    return profile.schema_tree(adapter.whole_lines(spark, sf))


@query
def p03_field_presence(spark, sf):
    d = profile.field_presence(adapter.whole_lines(spark, sf))
    return d.withColumn("pct", F.round("pct", 6))


@query
def p04_key_sets(spark, sf):
    return profile.key_sets(adapter.whole_lines(spark, sf), "$.payload")


@query
def p05_action_distribution(spark, sf):
    return profile.action_distribution(adapter.whole_lines(spark, sf), "PullRequestEvent")


@query
def p07_array_lengths(spark, sf):
    """Pushes with one commit more than the hour of the day says; other lines have no commits."""
    commits = F.transform(F.sequence(F.lit(0), F.hour("created_at")), lambda i: F.struct(i.alias("sha")))
    payload = F.when(F.col("event_type") == "PushEvent", F.struct(commits.alias("commits"))).alias("payload")
    return profile.array_lengths(feed(spark, sf).select(F.to_json(F.struct(payload)).alias("value")), "$.payload.commits")


@query
def p06_form_sizes(spark, sf):
    good, _ = ingest.parse_events(adapter.whole_lines(spark, sf), ingested_at=BATCH_TS)
    sizes = profile.form_sizes(spark, adapter.whole_lines(spark, sf), good.drop("ingested_at", "source_file"))
    return sizes.select("form", (F.col("bytes") > 0).alias("has_bytes"), (F.col("ratio") >= 1).alias("not_larger"))


# -- streaming ----------------------------------------------------------------------------------


def _stream(spark, rows: DataFrame) -> DataFrame:
    path = scratch_path(spark, "stream-in")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _drain(df: DataFrame, mode: str = "append") -> DataFrame:
    spark = df.sparkSession
    out = scratch_path(spark, "stream-out")
    q = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", scratch_path(spark, "stream-cp"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@query
def t01_stream_ingest(spark, sf):
    out = scratch_path(spark, "bronze")
    landing, checkpoint = _landing(spark, sf), scratch_path(spark, "cp")
    # The second run finds nothing new.
    for _ in range(2):
        stream_to_bronze(spark, landing, out, checkpoint, KEPT_TYPES, ingested_at=BATCH_TS).awaitTermination()
    return _with_file_names(read_bronze(spark, out))


def _with_file_names(rows: DataFrame) -> DataFrame:
    """``source_file`` without the scratch folder it lies in."""
    return rows.withColumn("source_file", F.regexp_extract("source_file", HOUR_NAME, 0))


@query
def t01b_stream_then_batch(spark, sf):
    """Every second hour by stream, then the whole range by batch, which skips what is there: one table."""
    lines, out, log = raw_lines(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    even = F.hour(hour_of_path(F.col("source_file"))) % 2 == 0
    part, landing = scratch_path(spark, "landing-part"), scratch_path(spark, "landing")
    adapter.land(lines.filter(even), part)
    adapter.land(lines, landing)
    stream_to_bronze(spark, part, out, scratch_path(spark, "cp"), KEPT_TYPES, run_log=log, ingested_at=BATCH_TS).awaitTermination()
    hours = i11_hour_range(spark, sf)
    ingest.ingest_hours(spark, landing, out, log, hours, event_types=KEPT_TYPES, ingested_at=BATCH_TS)
    return _with_file_names(read_bronze(spark, out))


@query
def t01c_stream_counters(spark, sf):
    out, log, bad = (scratch_path(spark, x) for x in ("bronze", "runlog", "quarantine"))
    stream = stream_to_bronze(spark, _landing(spark, sf), out, scratch_path(spark, "cp"), KEPT_TYPES, run_log=log, quarantine=bad)
    stream.awaitTermination()
    lost = spark.read.parquet(bad).groupBy(hour_of_path(F.col("source_file")).alias("hour")).agg(F.count("*").alias("quarantined"))
    runs_ = ingest.read_run_log(spark, log).groupBy(F.col("hour_processed").alias("hour")).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_written").alias("rows_kept"), F.sum("malformed_rows").alias("malformed_rows")
    )
    return runs_.join(lost, "hour", "left").na.fill(0, ["quarantined"])


@query
def t01d_stream_unreadable_files(spark, sf):
    """The feed streams in along with two hours whose file is no gzip or cut short: these fail, all others land."""
    landing, out, log = _landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "runlog")
    march = datetime(2024, 3, 1)
    for k, data in enumerate((b"no gzip", gzip.compress(b"{}" * 5000)[:-9])):
        adapter.put_bytes(spark, f"{landing}/{hour_name(march.replace(hour=k))}", data)
    stream_to_bronze(spark, landing, out, scratch_path(spark, "cp"), KEPT_TYPES, run_log=log, ingested_at=BATCH_TS).awaitTermination()
    error = F.regexp_extract(F.coalesce("error_message", F.lit("")), "^[a-z ]*", 0).alias("error")
    return ingest.read_run_log(spark, log).groupBy("status", error).agg(F.count("*").alias("hours"), F.sum("rows_written").alias("rows_kept"))


@query
def t02_stream_dedupe(spark, sf):
    rows = _drain(dedupe_stream(_stream(spark, bronze(spark, sf))))
    return rows.select("event_id", "event_type", "created_at", "repo_id")


@query
def t03_stream_upsert(spark, sf):
    rows = bronze(spark, sf).withColumn("date_key", date_key("created_at"))
    path, checkpoint, source = (scratch_path(spark, x) for x in ("fact", "cp", "stream-in"))
    for part in (_before(rows, SPLIT, "ingested_at"), _from(rows, SPLIT, "ingested_at")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        upsert_stream(stream, path, checkpoint, rows.schema).awaitTermination()
    return current(spark, path, rows.schema)


@query
def t04_stream_hourly_volume(spark, sf):
    path, checkpoint = scratch_path(spark, "volume"), scratch_path(spark, "cp")
    volume_to_table(_stream(spark, feed(spark, sf)), path, checkpoint).awaitTermination()
    return current(spark, path, "date_key int, event_hour bigint, event_count bigint")


@query
def t05_late_data(spark, sf):
    """Issue events arrive after all others: the stream drops those past the delay, batch has all."""
    rows = feed(spark, sf)
    path, checkpoint, source = (scratch_path(spark, x) for x in ("volume", "cp", "stream-in"))
    late = F.col("event_type") == "IssuesEvent"
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        volume_to_table(stream, path, checkpoint).awaitTermination()
    streamed = current(spark, path, "date_key int, event_hour bigint, event_count bigint")
    full = _volume(spark, sf).withColumnRenamed("event_count", "recovered_count")
    return full.join(streamed, ["date_key", "event_hour"], "left").select(
        "date_key", "event_hour", F.col("event_count").alias("streamed_count"), "recovered_count"
    )


@query
def t05b_late_rows(spark, sf):
    """As ``t05_late_data``, but rows past the delay come out at the side: streamed and late together equal the batch."""
    rows = feed(spark, sf)
    path, side, checkpoint, source = (scratch_path(spark, x) for x in ("volume", "late", "cp", "stream-in"))
    late = F.col("event_type") == "IssuesEvent"
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        volume_and_late_rows(stream, path, side, checkpoint).awaitTermination()
    streamed, missed = stored_volume(spark, path), late_rows(spark, side, rows.schema)
    return recovered_volume(streamed, missed).withColumnRenamed("event_count", "recovered_count").join(
        streamed.withColumnRenamed("event_count", "streamed_count"), ["date_key", "event_hour"], "left"
    )
