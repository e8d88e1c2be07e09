import random
from datetime import datetime, timedelta

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from hourlake.operators.scd import scd1_upsert, scd2_from_history, scd2_snapshot
from hourlake.plans import gold

CUR = "repo_id bigint, repo_name string, repo_owner string"
HIST = CUR + ", valid_from timestamp_ntz, valid_to timestamp_ntz"
T1, T2 = ts("2024-01-01T00:00:00"), ts("2024-02-01T00:00:00")


def snapshot(spark, current, history, as_of=T2):
    c = spark.createDataFrame(current, CUR)
    h = spark.createDataFrame(history, HIST)
    return rows(scd2_snapshot(c, h, "repo_id", ["repo_name", "repo_owner"], as_of))


def test_snapshot_opens_closes_and_keeps(spark):
    closed = (1, "first", "o", ts("2023-01-01T00:00:00"), T1)
    got = snapshot(
        spark,
        [(1, "same", "o"), (2, "after", "o"), (3, "new", "o"), (5, None, "o"), (6, "value", "o")],
        [
            closed,
            (1, "same", "o", T1, None),
            (2, "before", "o", T1, None),
            (4, "vanished", "o", T1, None),
            (5, "value", "o", T1, None),
            (6, None, "o", T1, None),
        ],
    )
    assert got == sorted(
        [
            closed,
            (1, "same", "o", T1, None),
            (2, "before", "o", T1, T2),
            (2, "after", "o", T2, None),
            (3, "new", "o", T2, None),
            (4, "vanished", "o", T1, None),
            (5, "value", "o", T1, T2),
            (5, None, "o", T2, None),
            (6, None, "o", T1, T2),
            (6, "value", "o", T2, None),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_snapshot_twice_changes_nothing(spark):
    current = spark.createDataFrame([(1, "a", "o"), (2, None, "o")], CUR)
    cols = ["repo_name", "repo_owner"]
    once = scd2_snapshot(current, spark.createDataFrame([], HIST), "repo_id", cols, T1)
    assert rows(scd2_snapshot(current, once, "repo_id", cols, T2)) == rows(once)


def test_history_versions(spark):
    obs = spark.createDataFrame(
        [
            (1, "a", ts("2024-01-01T00:00:00"), 1),
            (1, "a", ts("2024-01-02T00:00:00"), 2),
            (1, "b", ts("2024-01-03T00:00:00"), 3),
            (1, None, ts("2024-01-04T00:00:00"), 4),
            (1, "a", ts("2024-01-05T00:00:00"), 5),
            (1, "x", ts("2024-01-06T00:00:00"), 6),
            (1, "a", ts("2024-01-06T00:00:00"), 7),
            (None, "n", ts("2024-01-01T00:00:00"), 8),
        ],
        "k int, v string, t timestamp_ntz, id int",
    )
    got = scd2_from_history(obs, "k", ["v"], "t", ["id"]).orderBy("valid_from").collect()
    assert [(r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in got] == [
        ("a", 1, 3),
        ("b", 3, 4),
        (None, 4, 5),
        ("a", 5, None),
    ]


def brute_versions(obs):
    by_key = {}
    for k, v, t, i in obs:
        by_key.setdefault(k, {}).setdefault(t, []).append((i, v))
    out = []
    for k, times in by_key.items():
        starts = []
        for t in sorted(times):
            v = max(times[t])[1]
            if not starts or starts[-1][1] != v:
                starts.append((t, v))
        for n, (t, v) in enumerate(starts):
            out.append((k, v, t, starts[n + 1][0] if n + 1 < len(starts) else None))
    return out


@pytest.mark.parametrize("heavy_rows", [10, 60, 10**9])
def test_history_of_heavy_keys_equals_brute_force(spark, heavy_rows):
    rnd = random.Random(3)
    start = datetime(2024, 1, 1)
    obs = []
    for i in range(1500):
        k = 1 if rnd.random() < 0.4 else rnd.randrange(2, 40)
        # Many equal instants, also within the heavy key.
        obs.append((k, rnd.choice("abc"), start + timedelta(hours=rnd.randrange(300)), i))
    df = spark.createDataFrame(obs, "k int, v string, t timestamp_ntz, id int").repartition(7)
    got = scd2_from_history(df, "k", ["v"], "t", ["id"], heavy_rows=heavy_rows).drop("id")
    assert rows(got.select("k", "v", "valid_from", "valid_to")) == sorted(
        brute_versions(obs), key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def test_scd1_keeps_what_is_gone(spark):
    dim = spark.createDataFrame([("k1", 1, "old"), ("k2", 2, "gone")], "actor_key string, actor_id bigint, actor_login string")
    new = spark.createDataFrame([("k1", 1, "new"), ("k3", 3, "more")], dim.schema)
    assert rows(scd1_upsert(dim, new, "actor_id")) == [("k1", 1, "new"), ("k2", 2, "gone"), ("k3", 3, "more")]


def test_versions_survive_expired_events(spark):
    cols = "repo_id bigint, repo_name string, repo_owner string, repo_short_name string, created_at timestamp_ntz, event_id bigint"
    january = spark.createDataFrame(
        [(1, "o/a", "o", "a", ts("2024-01-01T00:00:00"), 1), (1, "o/b", "o", "b", ts("2024-01-20T00:00:00"), 2)], cols
    )
    february = spark.createDataFrame(
        [(1, "o/b", "o", "b", ts("2024-02-01T00:00:00"), 3), (1, "o/c", "o", "c", ts("2024-02-02T00:00:00"), 4)], cols
    )
    both = gold.dim_repo_history(january.unionByName(february))
    stepwise = gold.dim_repo_history(february, gold.dim_repo_history(january))
    assert rows(stepwise) == rows(both) and both.count() == 3
    dim = gold.with_repo_keys(both)
    assert dim.filter("is_current").select("repo_name").collect()[0][0] == "o/c"
    assert dim.select("repo_key").distinct().count() == 3
    assert dim.filter(F.col("valid_from") >= F.col("valid_to")).count() == 0
