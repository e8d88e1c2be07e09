"""Silver: one clean row per event, and the latest attributes of repositories and actors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourlake.functions import conform_name, event_date, event_hour, name_part, trim_spaces
from hourlake.operators.dedupe import latest_per_key, latest_value
from hourlake.schemas import BRONZE


def stg_events(bronze: DataFrame) -> DataFrame:
    """One row per ``event_id``: the latest ingested copy, conformed.

    Copies with the same ``ingested_at`` are told apart by ``created_at`` and then all other columns.
    """
    rows = bronze.select(*BRONZE.names)
    tiebreak = ["created_at", *[c for c in BRONZE.names if c not in ("event_id", "ingested_at", "created_at")]]
    latest = latest_per_key(rows, ["event_id"], ["ingested_at"], tiebreak)
    name = conform_name("repo_name")
    return latest.withColumn("repo_name", name).select(
        "event_id",
        "event_type",
        "created_at",
        "actor_id",
        trim_spaces("actor_login").alias("actor_login"),
        "repo_id",
        "repo_name",
        name_part("repo_name", 1).alias("repo_owner"),
        name_part("repo_name", 2).alias("repo_short_name"),
        "org_id",
        "action",
        "pr_number",
        "issue_number",
        event_date("created_at").alias("event_date"),
        event_hour("created_at").alias("event_hour"),
        "ingested_at",
        "source_file",
    )


def stg_repos(events: DataFrame) -> DataFrame:
    """One row per repository and day with the name seen last that day."""
    return latest_value(
        events.filter(F.col("repo_id").isNotNull()),
        ["repo_id", "event_date"],
        ["repo_name", "repo_owner", "repo_short_name"],
        ["created_at", "event_id"],
    ).select("repo_id", "repo_name", "repo_owner", "repo_short_name", "event_date")


def stg_actors(events: DataFrame) -> DataFrame:
    """One row per actor with the login seen last."""
    return latest_value(events, ["actor_id"], ["actor_login"], ["created_at", "event_id"])
