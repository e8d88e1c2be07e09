"""Pairing of a start event with its end events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourlake.functions.time import elapsed_hours
from hourlake.operators.skew import HEAVY_ROWS, salted_join


def first_seen(events: DataFrame, is_start: Column, keys: Sequence[str], ts: str, name: str) -> DataFrame:
    """Earliest start per key: ``keys`` and ``name``."""
    return (
        events.filter(is_start)
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.min(ts).alias(name))
    )


def open_merge_pairs(
    events: DataFrame,
    is_open: Column,
    is_merge: Column,
    keys: Sequence[str] = ("repo_id", "pr_number"),
    event_id: str = "event_id",
    ts: str = "created_at",
    merge_pick: str = "all",
    opened: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``merge_event_id, keys…, opened_at, merged_at, hours_to_merge``.

    Every merge is paired with the earliest opening of the same key; merges without one are absent.
    ``merge_pick='first'`` keeps only the earliest merge per key (ties: lowest event id).
    ``opened`` (``keys…, opened_at``) adds openings known from before the window of ``events``.
    """
    keys = list(keys)
    starts = first_seen(events, is_open, keys, ts, "opened_at")
    if opened is not None:
        starts = (
            starts.unionByName(opened.select(*keys, "opened_at"))
            .groupBy(*keys)
            .agg(F.min("opened_at").alias("opened_at"))
        )
    merged = (
        events.filter(is_merge)
        .dropna(subset=keys)
        .select(F.col(event_id).alias("merge_event_id"), *keys, F.col(ts).alias("merged_at"))
    )
    if merge_pick == "first":
        merged = (
            merged.groupBy(*keys)
            .agg(F.min(F.struct("merged_at", "merge_event_id")).alias("m"))
            .select("m.merge_event_id", *keys, "m.merged_at")
        )
        pairs = merged.join(starts, keys)
    elif merge_pick == "all":
        pairs = salted_join(merged, starts, keys, "inner", heavy_rows)
    else:
        raise ValueError(f"unknown merge_pick {merge_pick!r}")
    return pairs.select(
        "merge_event_id",
        *keys,
        "opened_at",
        "merged_at",
        elapsed_hours("opened_at", "merged_at").alias("hours_to_merge"),
    )
