"""Pipeline health: one row from the run log and the fact, as of an explicit ``now``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from hourlake.functions import date_key, elapsed_hours, ntz
from hourlake.operators.percentiles import grouped_percentiles


def run_rates(runs: DataFrame, now: datetime) -> DataFrame:
    """Runs, successes and success rate over 24 hours and 7 days; the rate is NULL without runs."""
    windows = {"24h": timedelta(hours=24), "7d": timedelta(days=7)}
    aggs = []
    for name, span in windows.items():
        recent = F.col("started_at") >= ntz(now - span)
        aggs.append(F.count_if(recent).alias(f"runs_{name}"))
        aggs.append(F.count_if(recent & (F.col("status") == "success")).alias(f"successes_{name}"))
    out = runs.agg(*aggs)
    for name in windows:
        rate = F.try_divide(F.col(f"successes_{name}").cast("double"), F.col(f"runs_{name}"))
        out = out.withColumn(f"success_rate_{name}", rate)
    return out


DURATIONS = "micros bigint, runs bigint, date_key int"
_DURATION = {"p50_duration_s": 0.5, "p95_duration_s": 0.95}


def duration_percentiles(runs: DataFrame) -> DataFrame:
    """Exact p50 and p95 of the run time over the whole history (microsecond resolution)."""
    return grouped_percentiles(runs, [], _micros(), 1_000_000.0, _DURATION, low_bits=20)


def _micros() -> Column:
    return F.round(F.col("duration_s") * 1_000_000)


def daily_durations(runs: DataFrame) -> DataFrame:
    """How often each run time occurs, by the day of the start: ``micros, runs, date_key``; days can be counted one by one."""
    rows = runs.select(_micros().cast("bigint").alias("micros"), date_key("started_at").alias("date_key"))
    return rows.groupBy("micros", "date_key").agg(F.count("*").alias("runs")).select("micros", "runs", "date_key")


def merged_duration_percentiles(daily: DataFrame) -> DataFrame:
    """As ``duration_percentiles``, from stored counts of all days."""
    return grouped_percentiles(daily, [], F.col("micros"), 1_000_000.0, _DURATION, low_bits=20, weight="runs")


def failure_streak(runs: DataFrame) -> DataFrame:
    """Failures since the newest run that did not fail; all runs if every one failed.

    Two aggregates instead of a numbering over all runs, which would sort them in one task.
    """
    last_good = runs.agg(F.max(F.when(F.col("status") != "failed", F.col("started_at"))).alias("t"))
    since = last_good.scalar()
    return runs.agg(
        F.count_if(since.isNull() | (F.col("started_at") > since)).alias("consecutive_failures")
    )


def data_age(fact: DataFrame, now: datetime) -> DataFrame:
    """Newest event and its age in hours."""
    newest = fact.agg(F.max("created_at").alias("latest_event_at"))
    return newest.withColumn("data_age_hours", elapsed_hours(F.col("latest_event_at"), ntz(now)))


def _scalar(df: DataFrame, name: str) -> Column:
    return df.select(name).scalar().alias(name)


def pipeline_health(runs: DataFrame, fact: DataFrame, now: datetime) -> DataFrame:
    """Exactly one row; every part is a one-row aggregate, put together as scalar subqueries."""
    pace, streak, age = duration_percentiles(runs), failure_streak(runs), data_age(fact, now)
    return run_rates(runs, now).select(
        ntz(now).alias("computed_at"),
        "runs_24h",
        "successes_24h",
        "success_rate_24h",
        "runs_7d",
        "successes_7d",
        "success_rate_7d",
        _scalar(pace, "p50_duration_s"),
        _scalar(pace, "p95_duration_s"),
        _scalar(streak, "consecutive_failures"),
        _scalar(age, "latest_event_at"),
        _scalar(age, "data_age_hours"),
    )
