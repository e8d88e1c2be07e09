"""Gold: dimensions and the event fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourlake.functions import date_key, elapsed_hours, surrogate_key
from hourlake.functions.time import FAR_FUTURE, ntz
from hourlake.operators.asof import point_in_time_join
from hourlake.operators.dedupe import latest_value
from hourlake.operators.pairing import first_seen, open_merge_pairs
from hourlake.operators.scd import scd1_upsert, scd2_from_history, scd2_snapshot
from hourlake.operators.skew import HEAVY_ROWS, salted_join
from hourlake.schemas import DIM_REPO, FACT_EVENTS
from hourlake.sources.seeds import event_types

REPO_ATTRIBUTES = ["repo_name", "repo_owner", "repo_short_name"]
REPO_CHECKED = ["repo_name", "repo_owner"]
PR_EVENT = "PullRequestEvent"


def is_opened() -> Column:
    return (F.col("event_type") == PR_EVENT) & (F.col("action") == "opened")


def merge_rows() -> Column:
    """For filtering: plain comparisons reach the Parquet scan."""
    return (F.col("event_type") == PR_EVENT) & (F.col("action") == "merged")


def is_merged() -> Column:
    """As a value: never NULL, an event without an action is not a merge."""
    return F.coalesce(merge_rows(), F.lit(False))


def dim_event_type(spark: SparkSession, seed: DataFrame | None = None) -> DataFrame:
    seed = event_types(spark) if seed is None else seed
    return seed.select(surrogate_key("event_type").alias("event_type_key"), *seed.columns)


def dim_actor(latest: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Type 1, one row per actor ever seen: actors that left the retained window stay."""
    new = latest.select(surrogate_key("actor_id").alias("actor_key"), "actor_id", "actor_login")
    return new if existing is None else scd1_upsert(existing, new, "actor_id")


def repo_current(repos: DataFrame) -> DataFrame:
    """One row per repository: its latest daily row."""
    return latest_value(repos, ["repo_id"], REPO_ATTRIBUTES, ["event_date"])


def with_repo_keys(versions: DataFrame) -> DataFrame:
    """Versions as ``dim_repo``: a key per version and the current flag."""
    return versions.select(
        surrogate_key("repo_id", "valid_from").alias("repo_key"),
        "repo_id",
        *REPO_ATTRIBUTES,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    ).select(*DIM_REPO.names)


def dim_repo_snapshot(repos: DataFrame, history: DataFrame, as_of: datetime) -> DataFrame:
    """Validity by run time: compare the latest daily rows with the stored versions."""
    return scd2_snapshot(repo_current(repos), history, "repo_id", REPO_CHECKED, as_of)


def dim_repo_history(
    events: DataFrame, existing: DataFrame | None = None, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Validity by event time, from the observations in ``events``.

    ``existing`` versions count as observations at their start, so versions outlive the retained
    events, while anything still retained is rebuilt and late arrivals split versions correctly.
    """
    obs = events.select("repo_id", *REPO_ATTRIBUTES, "created_at", "event_id")
    if existing is not None:
        known = existing.select(
            "repo_id",
            *REPO_ATTRIBUTES,
            F.col("valid_from").alias("created_at"),
            F.lit(None).cast("bigint").alias("event_id"),
        )
        obs = obs.unionByName(known)
    versions = scd2_from_history(obs, "repo_id", REPO_CHECKED, "created_at", ["event_id"], heavy_rows)
    return versions.drop("event_id")


def opened_prs(events: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Durable ``(repo_id, pr_number, opened_at)``: late merges still pair after events expire."""
    keys = ["repo_id", "pr_number"]
    found = first_seen(events, is_opened(), keys, "created_at", "opened_at")
    if existing is None:
        return found
    both = found.unionByName(existing.select(*found.columns))
    return both.groupBy(*keys).agg(F.min("opened_at").alias("opened_at"))


def pr_lifecycle(
    events: DataFrame, opened: DataFrame | None = None, merge_pick: str = "all", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """One row per merge event whose opening is known."""
    return open_merge_pairs(
        events, is_opened(), merge_rows(), opened=opened, merge_pick=merge_pick, heavy_rows=heavy_rows
    )


def outdated(
    events: DataFrame,
    fact: DataFrame,
    old_versions: DataFrame,
    versions: DataFrame,
    old_opened: DataFrame,
    opened: DataFrame,
) -> DataFrame:
    """``event_id`` of events whose stored fact row may refer to another repository version or opening now.

    Time is cut into versions, so an event changes its version only if its old one is gone or a new one now
    covers it. Only versions and openings that changed since are joined, never all of them.
    """
    gone = old_versions.join(versions, "repo_key", "left_anti").select("repo_key")
    lost = fact.join(gone, "repo_key", "left_semi").select("event_id")
    fresh = versions.join(old_versions, "repo_key", "left_anti").select(F.col("repo_id").alias("_repo"), "valid_from", "valid_to")
    inside = (F.col("created_at") >= F.col("valid_from")) & (F.col("created_at") < F.coalesce("valid_to", ntz(FAR_FUTURE)))
    covered = events.join(fresh, (F.col("repo_id") == F.col("_repo")) & inside, "left_semi").select("event_id")
    paired = opened.join(old_opened, ["repo_id", "pr_number", "opened_at"], "left_anti").select("repo_id", "pr_number")
    merges = events.filter(merge_rows()).join(paired, ["repo_id", "pr_number"], "left_semi").select("event_id")
    return lost.union(covered).union(merges).distinct()


def fact_events(
    events: DataFrame,
    dim_repo: DataFrame,
    opened: DataFrame,
    strategy: str = "auto",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per event.

    Actor and type keys are hashes of the natural keys, so those dimensions are not joined. Only
    merge rows, a small part of the events, go through the join that finds their opening; all other
    rows bypass it. Pass the published ``events`` table: it is scanned once for each part.
    """
    merges = salted_join(
        events.filter(merge_rows()), opened, ["repo_id", "pr_number"], "left", heavy_rows
    ).withColumn("hours_to_merge", elapsed_hours("opened_at", "created_at"))
    others = events.filter(~is_merged()).withColumn("hours_to_merge", F.lit(None).cast("double"))
    rows = others.unionByName(merges.drop("opened_at"))
    base = rows.select(
        "event_id",
        "event_type",
        "created_at",
        "ingested_at",
        surrogate_key("actor_id").alias("actor_key"),
        date_key("created_at").alias("date_key"),
        surrogate_key("event_type").alias("event_type_key"),
        "repo_id",
        "actor_id",
        "action",
        "pr_number",
        "issue_number",
        is_merged().alias("is_pr_merged"),
        "hours_to_merge",
    )
    versions = dim_repo.select("repo_id", "repo_key", "valid_from", "valid_to")
    joined = point_in_time_join(
        base, versions, "repo_id", "created_at", strategy=strategy, heavy_rows=heavy_rows
    )
    return joined.select(*FACT_EVENTS.names)
