import gzip
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourlake.operators import profile
from hourlake.operators.checks import ChecksFailed
from hourlake.plans import gold, ingest, marts, silver
from hourlake.plans.build import LakePaths, build
from hourlake.schemas import FACT_EVENTS
from hourlake.sources.bronze import read_bronze
from hourlake.sources.landing import hour_range


def lines(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


DOCS = (
    {"id": "1", "type": "A", "payload": {"n": 1, "list": [{"x": "s"}], "none": None}},
    {"id": "2", "type": "A", "payload": {"n": 2.5, "extra": True}},
    {"id": "3", "type": "B", "actor": {"login": None}},
    {"id": "4", "type": "B", "payload": {}},
)


def test_distribution(spark):
    assert rows(profile.type_distribution(lines(spark, *DOCS))) == [("A", 2, 50.0), ("B", 2, 50.0)]


def test_schema_tree_covers_all_lines(spark):
    got = rows(profile.schema_tree(lines(spark, *DOCS)))
    paths = {(t, p) for t, p, _ in got}
    assert {("A", "id"), ("A", "payload.n"), ("A", "payload.list[].x"), ("A", "payload.extra"), ("B", "actor.login")} <= paths
    types = {(t, p): d for t, p, d in got}
    assert types["A", "id"] == "STRING" and types["A", "payload.extra"] == "BOOLEAN"
    assert types["A", "payload.n"].startswith("DECIMAL")


def test_schema_tree_depth(spark):
    deep = {"type": "A"}
    node = deep
    for _ in range(10):
        node["k"] = {}
        node = node["k"]
    node["leaf"] = 1
    assert {p for _, p, _ in rows(profile.schema_tree(lines(spark, deep)))} == {"type", "k." * 10 + "leaf"}
    assert {p for _, p, _ in rows(profile.schema_tree(lines(spark, deep), max_depth=6))} == {"type"}


def test_presence_counts_null_as_absent(spark):
    got = {r["path"]: (r["present"], r["total"]) for r in profile.field_presence(
        lines(spark, *DOCS), ["id", "payload.n", "payload.none", "payload.list", "actor.login", "nope"]).collect()}
    assert got == {
        "id": (4, 4), "payload.n": (2, 4), "payload.none": (0, 4), "payload.list": (1, 4), "actor.login": (0, 4), "nope": (0, 4),
    }


def test_key_sets_and_actions(spark):
    assert rows(profile.key_sets(lines(spark, *DOCS), "$.payload")) == [(None, 1), ("", 1), ("extra,n", 1), ("list,n,none", 1)]
    acts = [{"type": "A", "payload": {"action": a}} for a in ("x", "x", "y")] + [{"type": "B", "payload": {"action": "x"}}]
    assert rows(profile.action_distribution(lines(spark, *acts), "A")) == [("x", 2), ("y", 1)]


def test_form_sizes(spark):
    df = lines(spark, *[{"id": str(i), "type": "A", "payload": {"text": "word " * 20, "n": i}} for i in range(2000)])
    got = {r["form"]: r for r in profile.form_sizes(spark, df, df.selectExpr("get_json_object(value, '$.id') id")).collect()}
    assert set(got) == {"raw", "gzip", "all_columns", "projected"}
    assert got["raw"]["ratio"] == 1.0 and got["gzip"]["ratio"] > 2
    assert got["projected"]["bytes"] < got["raw"]["bytes"]


# -- the whole lake -----------------------------------------------------------------------------

START = datetime(2024, 1, 15)


def feed_hour(rnd, hour, repos):
    out = []
    for i in range(60):
        at = START + timedelta(hours=hour, seconds=rnd.randrange(3600))
        repo = rnd.randrange(1, repos)
        kind = rnd.choice(["PushEvent", "PushEvent", "PullRequestEvent", "WatchEvent", "IssuesEvent", "OtherEvent"])
        payload = {}
        if kind == "PullRequestEvent":
            payload = {"action": rnd.choice(["opened", "merged"]), "pull_request": {"number": hour * 60 + i if hour == 0 else rnd.randrange(90)}}
            payload["pull_request"]["number"] %= 90
        out.append(json.dumps({
            "id": str(hour * 1000 + i),
            "type": kind,
            "created_at": at.isoformat() + "Z",
            "actor": {"id": rnd.randrange(1, 9), "login": f"u{rnd.randrange(99)}"},
            "repo": {"id": repo, "name": f"Own{repo}/Name{hour // 3 if repo % 2 else 0}"},
            "payload": payload,
        }))
    return out


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Six hours, ingested and built in three steps, with one hour corrected in between."""
    root = tmp_path_factory.mktemp("lake")
    landing, paths = str(root / "landing"), LakePaths(str(root / "lake"))
    os.makedirs(landing)

    def land(h, text):
        at = START + timedelta(hours=h)
        with gzip.open(f"{landing}/{at:%Y-%m-%d}-{at.hour}.json.gz", "wt") as f:
            f.write("\n".join(text) + "\n")

    def take(first, last, **kw):
        span = hour_range(spark, START + timedelta(hours=first), START + timedelta(hours=last))
        return ingest.ingest_hours(spark, landing, paths.bronze, paths.run_log, span, quarantine=paths.quarantine, **kw)

    rnd = random.Random(11)
    now = START + timedelta(hours=8)
    text = {h: feed_hour(rnd, h, 12) for h in range(6)}
    step, errors = 0, []

    def rebuild():
        nonlocal step
        step += 1
        try:
            return build(spark, paths, now, f"run{step}")
        except ChecksFailed as e:
            errors.append(str(e))

    for h in range(6):
        land(h, text[h])
    take(0, 1, ingested_at=now)
    rebuild()
    take(0, 3, ingested_at=now + timedelta(minutes=1))
    # Hour 1 is corrected: some events are gone from it, others changed their actor.
    text[1] = [ln.replace('"login": "u', '"login": "corrected') for ln in text[1]]
    land(1, text[1])
    take(1, 1, ingested_at=now + timedelta(minutes=2), force=True)
    rebuild()
    take(0, 5, ingested_at=now + timedelta(minutes=3))
    rebuild()
    return paths, errors, now


def fact_of(spark, paths):
    from hourlake.schemas import FACT_EVENTS
    from hourlake.sources.manifest import current

    return current(spark, paths.gold("fact_events"), FACT_EVENTS)


def test_steps_equal_one_rebuild(spark, lake):
    paths, _, _ = lake
    ev = silver.stg_events(read_bronze(spark, paths.bronze))
    whole = gold.fact_events(ev, gold.with_repo_keys(gold.dim_repo_history(ev)), gold.opened_prs(ev))
    stored = fact_of(spark, paths)
    assert rows(stored.select(*whole.columns)) == rows(whole)
    assert stored.count() == ev.count() > 200


def test_marts_follow_the_fact(spark, lake):
    paths, _, _ = lake
    from hourlake.operators.calendar import dim_date
    from hourlake.plans.build import ACTIVITY, VOLUME
    from hourlake.sources.manifest import current

    fact = fact_of(spark, paths)
    want = marts.daily_repo_activity(fact, dim_date(spark), gold.dim_event_type(spark))
    got = current(spark, paths.gold("mart_daily_repo_activity"), ACTIVITY)
    assert rows(got.select(*want.columns)) == rows(want)
    volume = current(spark, paths.gold("mart_hourly_volume"), VOLUME)
    assert rows(volume.select("event_hour", "event_count")) == rows(marts.hourly_volume(fact).select("event_hour", "event_count"))
    daily = current(spark, paths.gold("contributors"), marts.CONTRIBUTORS)
    whole = fact.filter("repo_id is not null").join(gold.dim_event_type(spark).select("event_type_key", "category"), "event_type_key")
    for unit in ("week", "month"):
        period = F.trunc("created_at", unit).alias("period")
        want = whole.groupBy("repo_id", "category", period).agg(F.countDistinct("actor_id").alias("distinct_contributors"))
        assert rows(marts.contributors(daily, unit)) == rows(want)


def test_only_repeated_merges_fail_the_checks(lake):
    _, errors, _ = lake
    allowed = {"test.pr_lifecycle.unique_repo_id_pr_number", "test.mart_pr_lifecycle.unique_repo_id_pr_number", "test.pr_lifecycle.merge_after_open"}
    for e in errors:
        assert set(e.split(", ")) <= allowed


def test_stored_check_states_equal_a_scan(spark, lake):
    paths, _, now = lake
    from hourlake.operators.checks import run_checks
    from hourlake.plans.build import check_states
    from hourlake.plans.quality import default_checks

    suite = [c for c in default_checks(now) if c.table == "fact_events" and c.row_test is not None]
    fact, states = {"fact_events": fact_of(spark, paths)}, check_states(spark, paths)
    assert len(suite) == 6 and rows(run_checks(suite, fact, {"fact_events": states})) == rows(run_checks(suite, fact))
    assert run_checks(suite, fact, {"fact_events": states.limit(0)}).filter("violations = 0").count() == 6


def test_ops_tables(spark, lake):
    paths, _, _ = lake
    from hourlake.schemas import CHECK_RESULTS, LEDGER
    from hourlake.sources.files import read_or_empty

    log = ingest.read_run_log(spark, paths.run_log)
    assert log.count() == 7 and log.filter("status != 'success'").count() == 0
    results = read_or_empty(spark, paths.check_results, CHECK_RESULTS)
    assert results.count() == 3 and {r["total_tests"] for r in results.collect()} == {65}
    assert read_or_empty(spark, paths.ledger, LEDGER).count() == 7


def test_building_again_changes_nothing(spark, lake):
    paths, errors, now = lake
    before = rows(fact_of(spark, paths))
    try:
        build(spark, paths, now, "again", retention_days=7)
    except ChecksFailed:
        pass
    assert rows(fact_of(spark, paths)) == before


def _small_lake(spark, tmp_path, name):
    return LakePaths(str(tmp_path / name))


def _put(spark, paths, *events):
    from conftest import bronze

    from hourlake.sources.bronze import partition_columns, write_bronze

    rows_ = bronze(spark, *events)
    day, hour = partition_columns(F.date_trunc("hour", "created_at").cast("timestamp_ntz"))
    write_bronze(rows_.select("*", day, hour), paths.bronze)


def _late_feed():
    """In-order hours first, then an earlier hour: it moves a version's start and brings an opening."""
    from conftest import event

    at = lambda h: datetime(2024, 1, 15, h)
    pr = dict(event_type="PullRequestEvent", pr_number=5)
    first = [
        event(1, created_at=at(10), source_file="h10"),
        event(2, created_at=at(11), source_file="h11", repo_name="octo/new"),
        event(3, created_at=at(11), source_file="h11", action="merged", **pr),
    ]
    late = [event(4, created_at=at(9), source_file="h9", action="opened", **pr), event(5, created_at=at(9), source_file="h9", repo_name="octo/old")]
    return first, late


def _whole(spark, paths):
    ev = silver.stg_events(read_bronze(spark, paths.bronze))
    return rows(gold.fact_events(ev, gold.with_repo_keys(gold.dim_repo_history(ev)), gold.opened_prs(ev)))


def _build(spark, paths, run):
    try:
        build(spark, paths, datetime(2024, 1, 16), run)
    except ChecksFailed:
        pass


def test_late_data_restates_the_fact(spark, tmp_path):
    paths = _small_lake(spark, tmp_path, "late")
    first, late = _late_feed()
    for k, part in enumerate((first, late)):
        _put(spark, paths, *part)
        _build(spark, paths, f"r{k}")
    assert rows(fact_of(spark, paths).select(*FACT_EVENTS.names)) == _whole(spark, paths)
    merged = fact_of(spark, paths).filter("event_id = 3").first()
    assert merged["hours_to_merge"] == 2.0


def test_the_next_build_repairs_a_dead_one(spark, tmp_path, monkeypatch):
    """Killed after every kind of write in turn, with late data in the feed."""
    from hourlake.operators.calendar import dim_date
    from hourlake.plans import build as module
    from hourlake.plans.build import ACTIVITY, VOLUME
    from hourlake.sources.manifest import current

    class Dead(Exception):
        pass

    paths = _small_lake(spark, tmp_path, "dead")
    first, late = _late_feed()
    _put(spark, paths, *first)
    _build(spark, paths, "r0")
    _put(spark, paths, *late)
    for name, calls in (("publish", 9), ("append", 1), ("replace_partitions", 1), ("append", 2), ("append", 3)):
        with monkeypatch.context() as m:
            real, count = getattr(module, name), [0]

            def dying(*a, _real=real, _count=count, _calls=calls, **kw):
                out = _real(*a, **kw)
                _count[0] += 1
                if _count[0] == _calls:
                    raise Dead
                return out

            m.setattr(module, name, dying)
            with pytest.raises(Dead):
                build(spark, paths, datetime(2024, 1, 16), "dies")
    _build(spark, paths, "repairs")
    fact = fact_of(spark, paths)
    assert rows(fact.select(*FACT_EVENTS.names)) == _whole(spark, paths)
    volume = current(spark, paths.gold("mart_hourly_volume"), VOLUME)
    assert rows(volume.select("event_hour", "event_count")) == rows(marts.hourly_volume(fact).select("event_hour", "event_count"))
    want = marts.daily_repo_activity(fact, dim_date(spark), gold.dim_event_type(spark))
    assert rows(current(spark, paths.gold("mart_daily_repo_activity"), ACTIVITY).select(*want.columns)) == rows(want)
    assert len([n for n in os.listdir(paths.gold("dim_repo")) if n.startswith("v=")]) == 2


def test_deep_and_dotted_keys_are_all_listed(spark):
    deep = '{"type":"x","a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":1}}}}}}},"p.q.r.s.t.u.v.w":2}'
    lines = spark.createDataFrame([(deep,)], "value string")
    paths = {r["path"] for r in profile.schema_tree(lines).collect()}
    assert paths == {"type", "a.b.c.d.e.f.g.h", "p.q.r.s.t.u.v.w"}
    assert {r["path"] for r in profile.schema_tree(lines, max_depth=1).collect()} == {"type", "p.q.r.s.t.u.v.w"}
