"""The check suite of the lake, freshness, the volume anomaly and failure reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hourlake.functions import micros, ntz
from hourlake.operators.checks import (
    WARN,
    Check,
    accepted_values,
    not_null,
    relationships,
    row_check,
    unique,
)
from hourlake.schemas import DEFAULT_EVENT_TYPES

# The event categories.
CATEGORIES = ("code", "collaboration", "social")


def future_event(now: datetime) -> Column:
    return F.col("created_at") > ntz(now)


def merged_before_opened() -> Column:
    return F.col("merged_at") < F.col("opened_at")


def volume_anomalies(volume: DataFrame, dim_date: DataFrame, sigmas: float = 3.0, fill_missing: bool = False) -> DataFrame:
    """Hours of the latest day far from the same hour of day over the 7 days before.

    Hours without variation, or with a single day of history, are not judged. ``fill_missing`` also
    judges hours that are absent, as zero events; by default only hours present are looked at.
    """
    days = F.broadcast(dim_date.select("date_key", "date_day"))
    hourly = volume.join(days, "date_key").select("date_day", "event_hour", "event_count")
    last_day = hourly.agg(F.max("date_day").alias("d")).scalar()
    week = F.expr("INTERVAL 7 DAY")
    recent = hourly.filter(F.col("date_day") >= last_day - week)
    if fill_missing:
        first_day = hourly.agg(F.min("date_day").alias("d")).scalar()
        grid = dim_date.filter(
            F.col("date_day").between(F.greatest(first_day, last_day - week), last_day)
        ).select("date_day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
        grid = grid.select("date_day", F.col("h").cast("bigint").alias("event_hour"))
        recent = grid.join(recent, ["date_day", "event_hour"], "left").fillna(0, ["event_count"])
    past = F.when(F.col("date_day") < last_day, F.col("event_count"))
    # 24 hours times 8 days: one group per hour of day holds both the history and today's value.
    stats = recent.groupBy("event_hour").agg(
        F.avg(past).alias("mean_count"),
        F.stddev_samp(past).alias("stddev_count"),
        F.max(F.when(F.col("date_day") == last_day, F.col("event_count"))).alias("event_count"),
    )
    off = F.abs(F.col("event_count") - F.col("mean_count")) > F.lit(sigmas) * F.col("stddev_count")
    return stats.filter((F.col("stddev_count") > 0) & off).select(
        last_day.alias("date_day"), "event_hour", "event_count", "mean_count", "stddev_count"
    )


def freshness(fact: DataFrame, now: datetime, sla_hours: float = 3) -> DataFrame:
    """One row: newest event, age, SLA, ``is_fresh`` and the band fresh / aging / stale.

    Exactly at the SLA is still fresh. A table without rows is stale, not an error.
    """
    age = (micros(ntz(now)) - micros("latest_event_at")) / F.lit(3_600_000_000.0)
    sla = F.lit(float(sla_hours))
    return (
        fact.agg(F.max("created_at").alias("latest_event_at"))
        .withColumn("age_hours", age)
        .select(
            F.coalesce(F.col("age_hours") <= sla, F.lit(False)).alias("is_fresh"),
            "latest_event_at",
            "age_hours",
            sla.alias("sla_hours"),
            freshness_band(F.col("age_hours"), sla).alias("band"),
        )
    )


def freshness_band(age: Column, sla: Column) -> Column:
    return F.when(age <= sla, "fresh").when(age <= sla * 2, "aging").otherwise("stale")


def failure_report(runs: DataFrame, step: str, run_url: str = "") -> DataFrame:
    """What somebody needs to start fixing a failed run: hour, step, error, link."""
    return runs.filter(F.col("status") == "failed").select(
        F.col("hour_processed").alias("hour"),
        F.lit(step).alias("step"),
        F.col("error_message").alias("error"),
        F.concat(F.lit(run_url), F.col("run_id")).alias("run_url"),
    )


def default_checks(now: datetime) -> list[Check]:
    """The declared checks over all tables of the lake (65, of which 6 only warn)."""

    def key(table: str, col: str) -> list[Check]:
        return [unique(table, col), not_null(table, col)]

    def present(table: str, *cols: str) -> list[Check]:
        return [not_null(table, c) for c in cols]

    return [
        # silver
        *key("stg_events", "event_id"),
        *present("stg_events", "event_type", "created_at", "actor_id", "actor_login", "event_date", "event_hour"),
        not_null("stg_events", "repo_id", severity=WARN),
        accepted_values("stg_events", "event_type", DEFAULT_EVENT_TYPES, severity=WARN),
        row_check("no_future_events", "stg_events", future_event(now)),
        *present("stg_repos", "repo_id", "event_date", "repo_name"),
        *key("stg_actors", "actor_id"),
        not_null("stg_actors", "actor_login"),
        # shared intermediate tables
        *key("pr_lifecycle", "merge_event_id"),
        not_null("pr_lifecycle", "hours_to_merge"),
        unique("pr_lifecycle", "repo_id", "pr_number"),
        row_check("merge_after_open", "pr_lifecycle", merged_before_opened()),
        *key("pipeline_runs", "run_id"),
        not_null("pipeline_runs", "status"),
        accepted_values("pipeline_runs", "status", ("success", "failed"), severity=WARN),
        # dimensions
        *key("dim_repo", "repo_key"),
        *present("dim_repo", "repo_id", "valid_from"),
        *key("dim_actor", "actor_key"),
        *key("dim_actor", "actor_id"),
        *key("dim_date", "date_key"),
        *key("dim_date", "date_day"),
        *key("dim_event_type", "event_type_key"),
        *key("dim_event_type", "event_type"),
        not_null("dim_event_type", "category"),
        accepted_values("dim_event_type", "category", CATEGORIES, severity=WARN),
        # fact
        *key("fact_events", "event_id"),
        *present("fact_events", "ingested_at", "actor_key", "date_key", "event_type_key", "is_pr_merged"),
        relationships("fact_events", "repo_key", "dim_repo", "repo_key", severity=WARN),
        relationships("fact_events", "actor_key", "dim_actor", "actor_key"),
        relationships("fact_events", "date_key", "dim_date", "date_key"),
        relationships("fact_events", "event_type_key", "dim_event_type", "event_type_key"),
        # marts
        *present("mart_daily_repo_activity", "repo_id", "event_count"),
        unique("mart_daily_repo_activity", "repo_id", "date_key", "category"),
        not_null("mart_pr_lifecycle", "hours_to_merge"),
        unique("mart_pr_lifecycle", "repo_id", "pr_number"),
        not_null("mart_hourly_volume", "event_count"),
        unique("mart_hourly_volume", "date_key", "event_hour"),
        *present("mart_pipeline_health", "consecutive_failures", "data_age_hours"),
        Check(
            "hourly_volume_not_anomalous",
            "mart_hourly_volume",
            lambda t: volume_anomalies(t["mart_hourly_volume"], t["dim_date"]),
            WARN,
        ),
    ]
