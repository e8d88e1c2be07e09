from datetime import date, datetime, timedelta

import pytest
from conftest import bronze, event, rows, ts
from pyspark.sql import functions as F

from hourlake.operators import checks
from hourlake.operators.calendar import dim_date
from hourlake.plans import analytics, health, quality
from hourlake.schemas import RUN_LOG

NOW = ts("2024-01-20T12:00:00")


def runs(spark, newest_first, step=timedelta(hours=1)):
    out = []
    for i, s in enumerate(newest_first):
        at = NOW - step * (i + 1)
        status = {"F": "failed", "S": "success"}[s]
        out.append((f"r{i}", at, at, float(i + 1), status, at, 1, 1, 0, 1, None))
    return spark.createDataFrame(out, RUN_LOG)


@pytest.mark.parametrize(("order", "streak"), [("FFSF", 2), ("FFF", 3), ("SFF", 0), ("", 0)])
def test_failure_streak(spark, order, streak):
    assert health.failure_streak(runs(spark, order)).first()[0] == streak


def test_health_row(spark):
    log = runs(spark, "SFSS", timedelta(hours=20))
    fact = bronze(spark, event(1, created_at=NOW - timedelta(hours=5)))
    r = health.pipeline_health(log, fact, NOW).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["runs_24h"], r["successes_24h"], r["success_rate_24h"]) == (1, 1, 1.0)
    assert (r["runs_7d"], r["successes_7d"], r["success_rate_7d"]) == (4, 3, 0.75)
    assert (r["p50_duration_s"], r["p95_duration_s"]) == (2.5, pytest.approx(3.85))
    assert (r["consecutive_failures"], r["data_age_hours"]) == (0, 5.0)


def test_health_without_runs(spark):
    r = health.pipeline_health(runs(spark, ""), bronze(spark), NOW).first()
    assert (r["runs_24h"], r["success_rate_24h"], r["success_rate_7d"]) == (0, None, None)
    assert (r["p50_duration_s"], r["consecutive_failures"], r["data_age_hours"]) == (None, 0, None)


@pytest.mark.parametrize(
    ("age", "fresh", "band"),
    [(1, True, "fresh"), (3, True, "fresh"), (3.01, False, "aging"), (6, False, "aging"), (10, False, "stale"), (None, False, "stale")],
)
def test_freshness(spark, age, fresh, band):
    df = bronze(spark) if age is None else bronze(spark, event(1, created_at=NOW - timedelta(hours=age)))
    r = quality.freshness(df, NOW, 3).first()
    assert (r["is_fresh"], r["band"]) == (fresh, band)
    assert r["age_hours"] == (None if age is None else pytest.approx(age))


def volume(spark, per_hour):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(8)]
    out = []
    for hour, counts in per_hour.items():
        for d, n in zip(days, counts):
            if n is not None:
                out.append((int(f"{d:%Y%m%d}"), hour, n))
    return spark.createDataFrame(out, "date_key int, event_hour bigint, event_count bigint")


def test_volume_anomaly(spark):
    v = volume(
        spark,
        {
            3: [10, 11, 12, 10, 11, 12, 11, 100],
            14: [20, 21, 22, 20, 21, 22, 21, 21],
            5: [7, 7, 7, 7, 7, 7, 7, 90],
            6: [None, None, None, None, None, None, 5, 500],
            8: [10, 11, 12, 10, 11, 12, 11, None],
        },
    )
    got = quality.volume_anomalies(v, dim_date(spark)).collect()
    assert [(r["event_hour"], r["event_count"], r["date_day"]) for r in got] == [(3, 100, ts("2024-01-08T00:00:00"))]
    filled = quality.volume_anomalies(v, dim_date(spark), fill_missing=True).collect()
    assert sorted((r["event_hour"], r["event_count"]) for r in filled) == [(3, 100), (6, 500), (8, 0)]


def test_check_kinds(spark):
    t = {
        "c": spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "z", 9), (None, "z", None)], "k int, v string, f int"),
        "p": spark.createDataFrame([(1,), (2,), (2,)], "f int"),
    }
    suite = [
        checks.unique("c", "k"),
        checks.unique("c", "k", "v"),
        checks.not_null("c", "k"),
        checks.not_null("c", "v"),
        checks.accepted_values("c", "v", ["a", "b"], severity=checks.WARN),
        checks.relationships("c", "f", "p", "f"),
        checks.row_check("small", "c", F.col("f") > 5, severity=checks.WARN),
    ]
    got = {r["unique_id"]: (r["violations"], r["status"]) for r in checks.run_checks(suite, t).collect()}
    assert got == {
        "test.c.unique_k": (1, "fail"),
        "test.c.unique_k_v": (1, "fail"),
        "test.c.not_null_k": (2, "fail"),
        "test.c.not_null_v": (0, "pass"),
        "test.c.accepted_values_v": (2, "warn"),
        "test.c.relationships_f": (1, "fail"),
        "test.c.small": (1, "warn"),
    }
    assert rows(suite[4].violations(t)) == [("z", 2)]
    assert rows(suite[5].violations(t)) == [(9, 1)]
    with pytest.raises(checks.ChecksFailed, match="not_null_k"):
        checks.raise_on_failure(checks.run_checks(suite, t))
    checks.raise_on_failure(checks.run_checks(suite[3:5], t))
    with pytest.raises(ValueError):
        checks.not_null("c", "k", severity="fatal")


def test_row_checks_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = checks.run_checks([checks.not_null("t", "id"), checks.not_null("t", "v"), checks.accepted_values("t", "v", [1])], {"t": df})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_summary(spark):
    df = spark.createDataFrame(
        [("test.a", "pass"), ("test.b", "pass"), ("test.c", "warn"), ("test.d", "fail"), ("test.e", "error"), ("model.m", "error")],
        "unique_id string, status string",
    )
    got = checks.summarise(df, NOW, "r").collect()
    assert [tuple(r) for r in got] == [("r", NOW, 5, 2, 1, 2)]
    assert checks.summarise(df.limit(0), NOW, "r").count() == 0
    assert analytics.latest_check_result(checks.summarise(df, NOW, "r")).first()["pass_rate"] == 0.4


def test_declared_suite():
    suite = quality.default_checks(NOW)
    assert len(suite) == 65 and sum(c.severity == checks.WARN for c in suite) == 6
    assert len({c.unique_id for c in suite}) == 65


def test_failure_report(spark):
    log = runs(spark, "FS").withColumn("error_message", F.lit("boom"))
    got = quality.failure_report(log, "ingest", "http://x/").collect()
    assert [tuple(r) for r in got] == [(NOW - timedelta(hours=1), "ingest", "boom", "http://x/r0")]


def test_histogram(spark):
    def hist(values):
        df = spark.createDataFrame([(float(v), ts("2024-01-15T00:00:00")) for v in values], "hours_to_merge double, merged_at timestamp_ntz")
        return {r["bin"]: r["n"] for r in analytics.merge_time_histogram(df, date(2024, 1, 1), date(2024, 1, 31)).collect()}

    assert hist(range(31)) == {**{i: 1 for i in range(1, 30)}, 30: 2}
    assert hist([5, 5, 5]) == {1: 3}
    assert hist([]) == {}


def test_calendar(spark):
    d = dim_date(spark)
    assert d.count() == 5844
    got = d.filter("date_key in (20240101, 20240106, 20210103)").orderBy("date_key").collect()
    assert [(r["day_of_week"], r["is_weekend"], r["iso_week"], r["quarter"]) for r in got] == [
        (0, True, 53, 1),
        (1, False, 1, 1),
        (6, True, 1, 1),
    ]
    assert got[1]["date_day"] == datetime(2024, 1, 1)
