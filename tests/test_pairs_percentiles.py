import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import bronze, event, rows, ts
from pyspark.sql import functions as F

from hourlake.operators.percentiles import grouped_percentiles
from hourlake.plans import gold, marts


def pr(event_id, action, at, number=7, repo=10):
    return event(event_id, event_type="PullRequestEvent", action=action, pr_number=number, repo_id=repo, created_at=ts(at))


def lifecycle(df, **kw):
    return rows(gold.pr_lifecycle(df, **kw).select("merge_event_id", "opened_at", "hours_to_merge"))


def test_pairs(spark):
    df = bronze(
        spark,
        pr(1, "opened", "2024-01-15T00:00:00.900000"),
        pr(2, "opened", "2024-01-15T05:00:00"),
        pr(3, "merged", "2024-01-15T00:00:02.100000"),
        pr(4, "merged", "2024-01-15T06:00:00"),
        pr(5, "merged", "2024-01-15T06:00:00", number=8),
        pr(6, "opened", "2024-01-15T06:00:00", number=9),
        pr(7, "merged", "2024-01-15T05:00:00", number=9),
        pr(8, "merged", "2024-01-15T05:00:00", repo=None),
        event(9, event_type="IssuesEvent", action="opened", pr_number=7, created_at=ts("2024-01-01T00:00:00")),
    )
    first = ts("2024-01-15T00:00:00.900000")
    want = [(3, first, 2 / 3600), (4, first, 6.0), (7, ts("2024-01-15T06:00:00"), -1.0)]
    assert lifecycle(df) == want
    assert lifecycle(df, heavy_rows=1) == want
    assert [r[0] for r in lifecycle(df, merge_pick="first")] == [3, 7]
    known = spark.createDataFrame([(10, 8, ts("2024-01-14T06:00:00"))], "repo_id bigint, pr_number int, opened_at timestamp_ntz")
    assert (5, ts("2024-01-14T06:00:00"), 24.0) in lifecycle(df, opened=known)
    with pytest.raises(ValueError):
        gold.pr_lifecycle(df, merge_pick="last")


def test_merge_flag_is_never_null(spark):
    df = bronze(spark, pr(1, "merged", "2024-01-15T00:00:00"), pr(2, None, "2024-01-15T00:00:00"), event(3))
    assert rows(df.select("event_id", gold.is_merged())) == [(1, True), (2, False), (3, False)]


def test_opened_prs_outlive_events(spark):
    january = bronze(spark, pr(1, "opened", "2024-01-01T00:00:00"))
    february = bronze(spark, pr(2, "opened", "2024-02-01T00:00:00"), pr(3, "opened", "2024-02-01T00:00:00", number=8))
    both = gold.opened_prs(february, gold.opened_prs(january))
    assert rows(both.select("pr_number", "opened_at")) == [(7, ts("2024-01-01T00:00:00")), (8, ts("2024-02-01T00:00:00"))]


@pytest.mark.parametrize("low_bits", [2, 6, 16])
def test_percentiles_equal_numpy(spark, low_bits):
    rnd = random.Random(2)
    data = []
    for g in range(6):
        n = (1, 2, 3, 50, 900, 1500)[g]
        for _ in range(n):
            # Negative values and many repetitions.
            data.append((g, rnd.randrange(-500, 3000) if rnd.random() < 0.5 else 77))
    data += [(9, None)]
    df = spark.createDataFrame(data, "g int, v int").repartition(5)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in grouped_percentiles(df, ["g"], F.col("v"), 10.0, probs, low_bits).collect()}
    assert sorted(got) == list(range(6))
    for g in range(6):
        vals = np.array([v for k, v in data if k == g]) / 10.0
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vals, p), abs=1e-9)
    whole = grouped_percentiles(df, [], F.col("v"), 10.0, {"m": 0.5}, low_bits).first()["m"]
    assert whole == pytest.approx(np.quantile([v / 10 for _, v in data if v is not None], 0.5))


def test_stored_counts_merge_to_exact_percentiles(spark):
    rnd = random.Random(4)
    data = [(g, rnd.randrange(0, 40) if rnd.random() < 0.8 else rnd.randrange(10**6), rnd.randrange(20)) for g in range(3) for _ in range(400)]
    rows_ = spark.createDataFrame(data, "g int, v int, day int").repartition(5)
    daily = rows_.groupBy("g", "v", "day").count()
    probs = {"p50": 0.5, "p95": 0.95}
    want = rows(grouped_percentiles(rows_, ["g"], F.col("v"), 1.0, probs, 4))
    assert rows(grouped_percentiles(daily, ["g"], F.col("v"), 1.0, probs, 4, weight="count")) == want


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "v int")
    assert grouped_percentiles(df, [], F.col("v"), 1.0, {"m": 0.5}).collect() == []


def test_lifecycle_mart(spark):
    start = datetime(2024, 1, 1)
    hours = [1, 2, 3, 4, 100]
    fact = spark.createDataFrame(
        [(10, i, start + timedelta(hours=h), float(h), True) for i, h in enumerate(hours)]
        + [(10, 99, start, None, True), (10, 98, start, 5.0, False)],
        "repo_id bigint, pr_number int, created_at timestamp_ntz, hours_to_merge double, is_pr_merged boolean",
    )
    got = marts.pr_lifecycle_mart(fact).collect()
    assert len(got) == 5
    assert {r["opened_at"] for r in got} == {start}
    assert {r["repo_p50_hours_to_merge"] for r in got} == {3.0}
    assert got[0]["repo_p95_hours_to_merge"] == pytest.approx(np.quantile(hours, 0.95))
