from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import hourlake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        hourlake.builder("tests")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *order: str) -> list[tuple]:
    """Collected rows as tuples, in a stable order."""
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))


EVENT_COLUMNS = (
    "event_id bigint, event_type string, created_at timestamp_ntz, actor_id bigint, actor_login string, repo_id bigint, "
    "repo_name string, org_id bigint, action string, pr_number int, issue_number int, ingested_at timestamp_ntz, source_file string"
)


_NOON = datetime(2024, 1, 15, 12)
_PLAIN_EVENT = (
    None, "PushEvent", _NOON, 1, "octo", 10, "octo/hello", None, None, None, None, _NOON.replace(hour=14), "2024-01-15-12.json.gz",
)


def event(event_id: int, **over) -> tuple:
    """A bronze row: a plain push with this id, and other values where given."""
    names = [c.split()[0] for c in EVENT_COLUMNS.split(", ")]
    unknown = set(over) - set(names)
    assert not unknown, unknown
    return tuple({**dict(zip(names, _PLAIN_EVENT)), "event_id": event_id, **over}[n] for n in names)


def bronze(spark, *events: tuple):
    return spark.createDataFrame(list(events), EVENT_COLUMNS)
