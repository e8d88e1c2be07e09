from conftest import bronze, event, rows, ts

from hourlake.operators.dedupe import latest_per_key
from hourlake.plans import silver


def test_latest_copy_wins(spark):
    df = bronze(
        spark,
        event(1, actor_login="old"),
        event(1, actor_login="new", ingested_at=ts("2024-01-15T15:00:00")),
        event(2, actor_login="only"),
    )
    assert rows(silver.stg_events(df).select("event_id", "actor_login")) == [(1, "new"), (2, "only")]


def test_ties_are_broken_the_same_way_every_time(spark):
    copies = [event(1, actor_login=f"l{i}") for i in range(20)] + [event(1, created_at=ts("2024-01-15T13:00:00"))]
    for order in (copies, copies[::-1]):
        got = silver.stg_events(bronze(spark, *order).repartition(5)).collect()
        assert [r["created_at"] for r in got] == [ts("2024-01-15T13:00:00")]


def test_names_are_conformed(spark):
    df = bronze(
        spark,
        event(1, repo_name="  Octo/Hello "),
        event(2, repo_name=" A/B "),
        event(3, repo_name="noslash"),
        event(4, repo_name=None),
        event(5, repo_name="a/b/c", actor_login=" x "),
        event(6, repo_name="\tt/u"),
    )
    got = {r["event_id"]: (r["repo_name"], r["repo_owner"], r["repo_short_name"]) for r in silver.stg_events(df).collect()}
    assert got == {
        1: ("octo/hello", "octo", "hello"),
        2: ("a/b", "a", "b"),
        3: ("noslash", "noslash", ""),
        4: (None, None, None),
        5: ("a/b/c", "a", "b"),
        6: ("\tt/u", "\tt", "u"),
    }


def test_daily_repos_and_actors(spark):
    df = silver.stg_events(
        bronze(
            spark,
            event(1, repo_name="a/old"),
            event(2, repo_name="a/new", created_at=ts("2024-01-15T13:00:00"), actor_login="z"),
            event(3, repo_name="a/next", created_at=ts("2024-01-16T01:00:00"), actor_login="y"),
            event(4, repo_id=None, actor_id=2),
        )
    )
    repos = rows(silver.stg_repos(df).select("event_date", "repo_name"))
    assert [(str(d), n) for d, n in repos] == [("2024-01-15", "a/new"), ("2024-01-16", "a/next")]
    assert rows(silver.stg_actors(df)) == [(1, "y"), (2, "octo")]


def test_key_only_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(latest_per_key(df, ["k"], [])) == [(1,), (2,)]


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(latest_per_key(df, ["k"], ["v"])) == [(None, 2), (1, 3)]
