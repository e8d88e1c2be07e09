import os
from datetime import date, timedelta

import pytest
from conftest import bronze, event, rows, ts

from hourlake.operators import retention
from hourlake.operators.upsert import batches, high_water, newer_than, unconsumed, upsert, upsert_table
from hourlake.sources import scratch
from hourlake.sources.bronze import read_bronze
from hourlake.sources.files import footprint, list_files, read_or_empty
from hourlake.sources.manifest import current, folders
from hourlake.sources.tables import append, compacted, drop_old_versions, publish, published, versions

KV = "k bigint, v string, day int"


def kv(spark, *data):
    return spark.createDataFrame(list(data), KV)


def test_publish_and_republish_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert published(spark, path, KV).count() == 0
    publish(kv(spark, (1, "a", 1)), path)
    publish(published(spark, path, KV).unionByName(kv(spark, (2, "b", 1))), path)
    assert rows(published(spark, path, KV).select("k")) == [(1,), (2,)]
    # A write that did not finish has no marker: readers do not see it, writers do not reuse it.
    os.makedirs(f"{path}/v=3")
    assert published(spark, path, KV).count() == 2
    publish(kv(spark, (9, "z", 1)), path)
    assert versions(spark, path) == [1, 2, 4]
    assert drop_old_versions(spark, path, keep=1) == 2
    assert rows(published(spark, path, KV).select("k")) == [(9,)]


def test_append_and_compact(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(4):
        append(kv(spark, (i, "x", 1)).coalesce(1), path)
    small = compacted(read_or_empty(spark, path, KV))
    assert small.rdd.getNumPartitions() == 1 and small.count() == 4


def test_high_water(spark):
    src = bronze(spark, *[event(i, ingested_at=ts(f"2024-01-0{i}T00:00:00"), source_file=f"f{i}") for i in (1, 2, 3)])
    stored = src.filter("event_id <= 2")
    assert [r["event_id"] for r in newer_than(src, stored).collect()] == [3]
    assert newer_than(src, stored.limit(0)).count() == 3
    assert high_water(stored.limit(0)) == ts("1900-01-01T00:00:00")
    # A batch stamped early but published late is lost to the mark, not to the ledger.
    late = src.filter("event_id = 1")
    ledger = batches(src.filter("event_id >= 2"))
    assert newer_than(late, src.filter("event_id >= 2")).count() == 0
    assert unconsumed(late, ledger).count() == 1


def test_upsert(spark):
    got = upsert(kv(spark, (1, "a", 1), (2, "b", 1)), kv(spark, (2, "c", 2), (3, "d", 2)), ["k"])
    assert rows(got) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]


def test_upsert_table_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    put = lambda *d, **kw: upsert_table(spark, path, kv(spark, *d), ["k"], "day", KV, **kw)
    table = lambda: rows(current(spark, path, KV).select("k", "v", "day"))
    assert put((1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)) == [1, 2, 3]
    assert {f: x["change"] for f, x in folders(spark, path).items()} == {"day=1": 1, "day=2": 1, "day=3": 1}
    assert put((1, "moved", 3)) == [1, 3]
    assert table() == [(1, "moved", 3), (2, "b", 1), (3, "c", 2), (4, "d", 3)]
    assert {f: x["change"] for f, x in folders(spark, path).items()} == {"day=1": 2, "day=2": 1, "day=3": 2}
    # The last row leaves partition 1.
    assert put((2, "gone", 2)) == [1, 2]
    assert set(folders(spark, path)) == {"day=2", "day=3"}
    assert table() == [(1, "moved", 3), (2, "gone", 2), (3, "c", 2), (4, "d", 3)]
    # Again the same: nothing changes.
    put((2, "gone", 2))
    assert len(table()) == 4
    assert put() == []
    # Whatever day a row moves from, no old copy stays.
    noted = []
    assert put((4, "e", 1), before_write=noted.extend) == [1, 3] == sorted(noted)
    assert table() == [(1, "moved", 3), (2, "gone", 2), (3, "c", 2), (4, "e", 1)]


def test_batches_equal_one_load(spark, tmp_path):
    data = [(i % 40, f"v{i}", i % 40 % 5) for i in range(200)]
    path = str(tmp_path / "fact")
    for start in range(0, 200, 40):
        upsert_table(spark, path, kv(spark, *data[start : start + 40]), ["k"], "day", KV)
    assert rows(current(spark, path, KV).select("k", "v", "day")) == rows(kv(spark, *data[160:]))


def test_read_or_empty_only_hides_absence(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "none"), KV).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("this is not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(bad), KV).count()


def test_scratch_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(root)
    df = spark.range(5)
    assert scratch.written(df, "x").count() == 5


def _partition(spark, root, day, n=1):
    spark.range(n).selectExpr("id as event_id").write.parquet(f"{root}/event_date={day}/hour=05")


TODAY = date(2024, 1, 31)


def test_retention(spark, tmp_path):
    root = str(tmp_path / "bronze" / "events")
    days = {n: TODAY - timedelta(days=n) for n in (10, 8, 7, 1)}
    for d in days.values():
        _partition(spark, root, d)
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "fact.parquet").write_bytes(b"some bytes")
    files = list_files(spark, str(tmp_path), "*.parquet")
    expired = retention.expired_partitions(files, TODAY, 7)
    assert sorted(r["event_date"] for r in expired.collect()) == [days[10], days[8]]
    total = retention.reclaimable(expired, TODAY, 7).first()
    assert (total["cutoff_date"], total["dates_expired"]) == (days[7], 2) and total["bytes_reclaimable"] > 0
    zero = retention.reclaimable(retention.expired_partitions(files, TODAY, 30), TODAY, 30).first()
    assert (zero["dates_expired"], zero["files_expired"], zero["bytes_reclaimable"]) == (0, 0, 0)
    kept = retention.retained(read_bronze(spark, root), TODAY, 7).select("event_date").distinct()
    assert sorted(r[0] for r in kept.collect()) == [days[7], days[1]]
    assert "PartitionFilters: [isnotnull(event_date" in kept._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        retention.cutoff(TODAY, 0)


def test_listing_with_a_relative_root(spark, tmp_path, monkeypatch):
    _partition(spark, str(tmp_path / "data"), TODAY - timedelta(days=30))
    rel = os.path.relpath(tmp_path / "data")
    expired = retention.expired_partitions(list_files(spark, rel, "*.parquet"), TODAY, 7)
    assert expired.count() == 1


def test_footprint(spark, tmp_path):
    _partition(spark, str(tmp_path / "bronze"), TODAY, 100)
    zones = {"bronze": str(tmp_path / "bronze"), "silver": str(tmp_path / "silver")}
    got = {r["zone"]: r for r in footprint(spark, zones).collect()}
    assert got["bronze"]["file_count"] >= 1 and got["bronze"]["bytes"] > 0
    assert got["bronze"]["mb"] == pytest.approx(got["bronze"]["bytes"] / 1024**2)
    assert (got["silver"]["file_count"], got["silver"]["bytes"]) == (0, 0)


def test_scratch_can_be_cleared(spark):
    path = scratch.scratch_path(spark, "y")
    spark.range(3).write.parquet(path)
    scratch.clear_scratch(spark)
    assert not os.path.exists(path)
