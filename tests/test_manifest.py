"""Changes of partitioned tables are whole or not there; the key index finds old versions without reading other days."""

from __future__ import annotations

import os

import pytest
from conftest import rows

from hourlake.operators import upsert
from hourlake.operators.upsert import may_hold, replace_partitions, upsert_table
from hourlake.sources import manifest
from hourlake.sources.manifest import ConcurrentChange, changes, current, drop_unreferenced, folders, publish_partitions

KV = "k bigint, v string, day int"


def kv(spark, *data):
    return spark.createDataFrame(list(data), KV)


def state(spark, path, **kw):
    return rows(current(spark, path, KV, **kw))


class Dead(Exception):
    pass


@pytest.mark.parametrize("at", ["_index", "_put", "write"])
def test_a_writer_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "fact")
    put = lambda *d: upsert_table(spark, path, kv(spark, *d), ["k"], "day", KV)
    put(*[(i, "a", i % 5) for i in range(50)])
    before = state(spark, path)
    news = [(i, "b", (i + 1) % 5) for i in range(0, 50, 2)]
    with monkeypatch.context() as m:
        if at == "write":  # after some partitions of the change are written, before all are
            from pyspark.sql import functions as F

            broken = kv(spark, *news).withColumn("v", F.when(F.col("day") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
            with pytest.raises(Exception, match="lost"):
                publish_partitions(broken, path, "day", [0, 1, 2, 3, 4], ["k"])
        else:
            real = getattr(manifest, at)

            def dying(*a, **kw):
                if at == "_index":
                    real(*a, **kw)
                raise Dead

            m.setattr(manifest, at, dying)
            with pytest.raises(Dead):
                put(*news)
    assert state(spark, path) == before
    put(*news)
    old = [r for r in before if r[0] % 2]
    assert state(spark, path) == sorted(old + [(k, v, d) for k, v, d in news], key=lambda r: tuple((x is not None, str(x)) for x in r))
    drop_unreferenced(spark, path, keep=1)
    assert len(state(spark, path)) == 50 and len(changes(spark, path)) == 1


def test_readers_keep_the_state_they_started_from(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish_partitions(kv(spark, (1, "a", 1), (2, "b", 2)), path, "day", [1, 2])
    then = current(spark, path, KV)
    publish_partitions(kv(spark, (3, "c", 2)), path, "day", [1, 2])
    assert rows(then) == [(1, "a", 1), (2, "b", 2)] == state(spark, path, change=first)
    assert state(spark, path) == [(3, "c", 2)]
    assert state(spark, path, only=["day=1"]) == []


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_partitions(kv(spark, (1, "a", 1)), path, "day", [1])
    real = manifest._put

    def second_first(spark_, path_, change, now, base):
        monkeypatch.setattr(manifest, "_put", real)
        publish_partitions(kv(spark, (2, "b", 1)), path, "day", [1])
        real(spark_, path_, change, now, base)

    monkeypatch.setattr(manifest, "_put", second_first)
    with pytest.raises(ConcurrentChange):
        publish_partitions(kv(spark, (3, "c", 1)), path, "day", [1])
    assert state(spark, path) == [(2, "b", 1)]


def test_a_taken_name_is_never_overwritten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_partitions(kv(spark, (1, "a", 1)), path, "day", [1])
    state_ = folders(spark, path)
    monkeypatch.setattr(manifest, "changes", lambda *a: [])  # both writers saw the same state
    with pytest.raises(ConcurrentChange):
        manifest._put(spark, path, 1, {}, 0)
    monkeypatch.undo()
    assert folders(spark, path) == state_ and not [n for n in os.listdir(f"{path}/manifest") if n.startswith("_")]


def test_rows_outside_the_listed_partitions_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="other partitions"):
        publish_partitions(kv(spark, (1, "a", 1), (2, "a", 2)), path, "day", [1])
    assert changes(spark, path) == []


def test_other_days_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    upsert_table(spark, path, kv(spark, *[(i, "a", i % 20) for i in range(4000)]), ["k"], "day", KV)
    assert may_hold(spark, path, kv(spark, (7, "b", 3)), ["k"], "day") == [7]
    assert may_hold(spark, path, kv(spark, (100_000, "b", 3)), ["k"], "day") == []
    read = []
    real = upsert.current
    monkeypatch.setattr(upsert, "current", lambda *a, **kw: read.append(sorted(kw["only"])) or real(*a, **kw))
    assert upsert_table(spark, path, kv(spark, (7, "b", 3)), ["k"], "day", KV) == [3, 7]
    assert read == [["day=7"], ["day=3", "day=7"]]
    files = real(spark, path, KV, only=["day=7"]).inputFiles()
    assert files and all("/day=7/" in f for f in files)


def test_no_key_is_ever_missed_by_the_index(spark, tmp_path):
    path = str(tmp_path / "fact")
    data = [(i * 7919 % 100_003, "a", i % 3) for i in range(3000)]
    upsert_table(spark, path, kv(spark, *data), ["k"], "day", KV)
    for day in range(3):
        own = [(k, "x", 9) for k, _, d in data if d == day]
        assert day in may_hold(spark, path, kv(spark, *own[::50]), ["k"], "day")


def test_tables_without_an_index_are_searched_whole(spark, tmp_path):
    path = str(tmp_path / "fact")
    replace_partitions(kv(spark, (1, "a", 1), (2, "a", 2)), path, "day", [1, 2])
    assert sorted(may_hold(spark, path, kv(spark, (9, "b", 3)), ["k"], "day")) == [1, 2]
    assert upsert_table(spark, path, kv(spark, (2, "b", 1)), ["k"], "day", KV) == [1, 2]
    assert state(spark, path) == [(1, "a", 1), (2, "b", 1)]


def test_null_and_text_partitions(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "k bigint, day string"
    put = lambda *d: upsert_table(spark, path, spark.createDataFrame(list(d), ddl), ["k"], "day", ddl)
    put((1, "a b/c=d"), (2, None), (None, "x"))
    put((2, "x"), (1, None))
    assert rows(current(spark, path, ddl)) == [(None, "x"), (1, None), (2, "x")]
