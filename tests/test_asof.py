import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from conftest import rows, ts

from hourlake.operators import skew
from hourlake.operators.asof import point_in_time_join

DIM = "k bigint, name string, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACT = "id bigint, k bigint, t timestamp_ntz"
VERSIONS = [
    (1, "old/name", ts("2024-01-01T00:00:00"), ts("2024-03-01T00:00:00")),
    (1, "new/name", ts("2024-03-01T00:00:00"), None),
]
STRATEGIES = ["range", "window", "auto"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rename(spark, strategy):
    fact = spark.createDataFrame(
        [
            (1, 1, ts("2024-02-10T00:00:00")),
            (2, 1, ts("2024-08-10T00:00:00")),
            (3, 1, ts("2024-03-01T00:00:00")),
            (4, 1, ts("2023-12-31T00:00:00")),
            (5, None, ts("2024-02-10T00:00:00")),
            (6, 9, ts("2024-02-10T00:00:00")),
        ],
        FACT,
    )
    dim = spark.createDataFrame(VERSIONS, DIM)
    got = point_in_time_join(fact, dim, "k", "t", strategy=strategy)
    assert got.columns == ["id", "k", "t", "name", "valid_from", "valid_to"]
    assert {r["id"]: r["name"] for r in got.collect()} == {
        1: "old/name",
        2: "new/name",
        3: "new/name",
        4: None,
        5: None,
        6: None,
    }
    inner = point_in_time_join(fact, dim, "k", "t", how="inner", strategy=strategy)
    assert sorted(r["id"] for r in inner.collect()) == [1, 2, 3]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_gaps_and_empty_versions(spark, strategy):
    dim = spark.createDataFrame(
        [
            (1, "a", ts("2024-01-01T00:00:00"), ts("2024-01-05T00:00:00")),
            (1, "never", ts("2024-01-10T00:00:00"), ts("2024-01-10T00:00:00")),
            (1, "b", ts("2024-01-10T00:00:00"), None),
        ],
        DIM,
    )
    fact = spark.createDataFrame([(d, 1, datetime(2024, 1, d)) for d in (4, 5, 9, 10, 11)], FACT)
    got = point_in_time_join(fact, dim, "k", "t", strategy=strategy)
    assert {r["id"]: r["name"] for r in got.collect()} == {4: "a", 5: None, 9: None, 10: "b", 11: "b"}


@pytest.mark.parametrize("heavy_rows", [7, 50, 400, 10**9])
def test_heavy_keys_equal_brute_force(spark, heavy_rows):
    rnd = random.Random(5)
    start = datetime(2024, 1, 1)
    versions = []
    for k in range(12):
        n = 120 if k == 0 else rnd.randrange(1, 6)
        cuts = sorted(rnd.sample(range(5000), n))
        for i, c in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else None
            versions.append((k, f"{k}-{i}", start + timedelta(minutes=c), None if end is None else start + timedelta(minutes=end)))
    fact = []
    for i in range(2500):
        r = rnd.random()
        k = 0 if r < 0.35 else None if r < 0.45 else rnd.randrange(14)
        # A tenth of the rows share one instant.
        minute = 2500 if rnd.random() < 0.1 else rnd.randrange(-50, 5200)
        fact.append((i, k, start + timedelta(minutes=minute)))
    by_key = {}
    for v in versions:
        by_key.setdefault(v[0], []).append(v)
    want = {}
    for i, k, t in fact:
        hits = [v[1] for v in by_key.get(k, []) if v[2] <= t and (v[3] is None or t < v[3])]
        want[i] = hits[0] if hits else None
    f = spark.createDataFrame(fact, FACT).repartition(6)
    d = spark.createDataFrame(versions, DIM).repartition(3)
    for strategy in ("window", "range"):
        got = point_in_time_join(f, d, "k", "t", strategy=strategy, heavy_rows=heavy_rows).collect()
        assert len(got) == len(fact)
        assert {r["id"]: r["name"] for r in got} == want


def test_heavy_keys_are_really_split(spark):
    start = datetime(2024, 1, 1)
    # One instant holds most of the rows of key 1.
    data = [(1, start)] * 600 + [(1, start + timedelta(hours=i)) for i in range(1, 200)] + [(2, start)] * 5
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(data)], FACT)
    spans = skew.find_spans(df, ["k"], "t", heavy_rows=100)
    sizes = spans.assign(df, "t", spread_ties_by=["id"]).groupBy("k", "_span").count().collect()
    assert len([r for r in sizes if r["k"] == 1]) >= 6
    assert max(r["count"] for r in sizes if r["k"] == 1) < 300
    assert skew.find_spans(df, ["k"], "t", heavy_rows=10_000) is None


def test_unknown_arguments(spark):
    dim, fact = spark.createDataFrame(VERSIONS, DIM), spark.createDataFrame([], FACT)
    with pytest.raises(ValueError):
        point_in_time_join(fact, dim, "k", "t", how="right")
    with pytest.raises(ValueError):
        point_in_time_join(fact, dim, "k", "t", strategy="nested")


def test_no_nested_loop_in_the_plan(spark):
    fact = spark.range(1000).selectExpr("id", "id % 10 as k", "timestamp_ntz'2024-02-01 00:00:00' as t")
    dim = spark.createDataFrame(VERSIONS, DIM)
    for strategy in ("range", "window"):
        plan = point_in_time_join(fact, dim, "k", "t", strategy=strategy)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heavy_rows", [5, 10**9])
def test_salted_join_equals_plain_join(spark, how, heavy_rows):
    rnd = random.Random(1)
    pick = lambda: None if rnd.random() < 0.1 else 1 if rnd.random() < 0.5 else rnd.randrange(20)
    left = spark.createDataFrame([(i, pick(), rnd.randrange(3)) for i in range(400)], "id int, a int, b int")
    right = spark.createDataFrame([(k, b, k * 10 + b) for k in range(15) for b in range(2)], "a int, b int, v int")
    got = skew.salted_join(left, right, ["a", "b"], how, heavy_rows)
    assert rows(got.select(*sorted(got.columns))) == rows(
        left.join(right, ["a", "b"], how).select(*sorted(got.columns))
    )


@pytest.mark.parametrize("versions", [3, 33])
def test_overlapping_versions_give_one_row_in_every_strategy(spark, versions):
    start = datetime(2024, 1, 1)
    fact = spark.createDataFrame([(1, 1, start + timedelta(days=50)), (2, 1, start + timedelta(hours=1)), (3, 9, start)], FACT)
    dim = spark.createDataFrame([(1, f"v{i}", start + timedelta(days=i), None) for i in range(versions)], DIM)
    want = {1: f"v{versions - 1}", 2: "v0", 3: None}
    for strategy in ("auto", "range", "window"):
        got = point_in_time_join(fact, dim, "k", "t", strategy=strategy).collect()
        assert {r["id"]: r["name"] for r in got} == want and len(got) == 3


def test_every_heavy_key_is_split(spark):
    df = spark.range(0, 40_000).selectExpr("id", "id % 2000 as k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) as t")
    spans = skew.find_spans(df, ["k"], "t", heavy_rows=10)
    sizes = spans.assign(df, "t").groupBy("k").agg(F.count_distinct("_span").alias("spans"))
    assert sizes.filter("spans >= 2").count() == 2000


def test_the_largest_key_gets_as_many_pieces_as_it_needs(spark):
    df = spark.range(0, 30_000).selectExpr("id", "if(id % 3 = 0, id, 0) as k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) as t")
    sizes = skew.find_spans(df, ["k"], "t", heavy_rows=20).assign(df, "t").filter("k = 0").groupBy("_span").count()
    assert sizes.count() > 900 and sizes.agg(F.max("count")).first()[0] < 60
