"""Table contracts. Schemas are always declared, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_TS, _D, _B, _DBL = T.TimestampNTZType(), T.DateType(), T.BooleanType(), T.DoubleType()


def _struct(*fields: tuple) -> T.StructType:
    """Fields are ``(name, type)`` or ``(name, type, nullable)``."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


#: One row per kept source line; the last two columns are lineage.
BRONZE = _struct(
    ("event_id", _L, False),
    ("event_type", _S, False),
    ("created_at", _TS, False),
    ("actor_id", _L, False),
    ("actor_login", _S, False),
    ("repo_id", _L),
    ("repo_name", _S),
    ("org_id", _L),
    ("action", _S),
    ("pr_number", _I),
    ("issue_number", _I),
    ("ingested_at", _TS, False),
    ("source_file", _S, False),
)

#: Directory keys of the bronze layout; ``hour`` stays a string to keep ``05``.
BRONZE_PARTITIONS = _struct(("event_date", _D), ("hour", _S))

RUN_LOG = _struct(
    ("run_id", _S, False),
    ("started_at", _TS, False),
    ("finished_at", _TS, False),
    ("duration_s", _DBL, False),
    ("status", _S, False),
    ("hour_processed", _TS, False),
    ("rows_read", _L, False),
    ("rows_written", _L, False),
    ("malformed_rows", _L, False),
    ("bytes_written", _L, False),
    ("error_message", _S),
)

CHECK_RESULTS = _struct(
    ("run_id", _S, False),
    ("recorded_at", _TS, False),
    ("total_tests", _L, False),
    ("passed_tests", _L, False),
    ("warned_tests", _L, False),
    ("failed_tests", _L, False),
)

EVENT_TYPES = _struct(("event_type", _S), ("description", _S), ("category", _S))

DIM_REPO = _struct(
    ("repo_key", _S),
    ("repo_id", _L),
    ("repo_name", _S),
    ("repo_owner", _S),
    ("repo_short_name", _S),
    ("valid_from", _TS),
    ("valid_to", _TS),
    ("is_current", _B),
)

DIM_ACTOR = _struct(("actor_key", _S), ("actor_id", _L), ("actor_login", _S))

FACT_EVENTS = _struct(
    ("event_id", _L),
    ("event_type", _S),
    ("created_at", _TS),
    ("ingested_at", _TS),
    ("repo_key", _S),
    ("actor_key", _S),
    ("date_key", _I),
    ("event_type_key", _S),
    ("repo_id", _L),
    ("actor_id", _L),
    ("action", _S),
    ("pr_number", _I),
    ("issue_number", _I),
    ("is_pr_merged", _B),
    ("hours_to_merge", _DBL),
)

#: Which ingested batches a downstream table has already consumed.
LEDGER = _struct(("source_file", _S), ("ingested_at", _TS))

# The event types the feed is filtered to by default.
DEFAULT_EVENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "IssueCommentEvent",
    "WatchEvent",
    "ForkEvent",
)
