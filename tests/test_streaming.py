import gzip
import os
from datetime import datetime, timedelta

from conftest import EVENT_COLUMNS, bronze, event, rows, ts
from test_ingest import line
from pyspark.sql import functions as F

from hourlake.functions import date_key
from hourlake.plans import ingest, marts, silver
from hourlake.sources.bronze import read_bronze
from hourlake.sources.landing import hour_range
from hourlake.sources.manifest import current
from hourlake.streaming import (
    dedupe_stream,
    hourly_volume_stream,
    late_rows,
    recovered_volume,
    stored_volume,
    stream_to_bronze,
    upsert_stream,
    volume_and_late_rows,
    volume_to_table,
)
from hourlake.streaming.events import VOLUME_SCHEMA

TYPES = ("PushEvent", "PullRequestEvent")


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}", "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_every_file_is_ingested_once(spark, tmp_path):
    landing, out, cp = (str(tmp_path / n) for n in ("landing", "bronze", "cp"))
    ids = lambda: sorted(r[0] for r in read_bronze(spark, out).select("event_id").collect())
    run = lambda: stream_to_bronze(spark, landing, out, cp, TYPES, max_files=1).awaitTermination()
    land(landing, "2024-01-15-5.json.gz", [line(1), "{bad", "", line(2, "WatchEvent")])
    land(landing, "2024-01-15-6.json.gz", [line(3)])
    run()
    assert ids() == [1, 3]
    run()
    assert ids() == [1, 3]
    land(landing, "2024-01-15-7.json.gz", [line(4)])
    run()
    assert ids() == [1, 3, 4]
    assert os.path.isdir(f"{out}/event_date=2024-01-15/hour=05")


def add(df, source):
    df.write.mode("append").parquet(source)


def test_dedupe_keeps_one_row_per_key(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    stream = lambda: dedupe_stream(spark.readStream.schema(EVENT_COLUMNS).parquet(source))

    def run():
        q = stream().writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out)
        q.awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(out).collect())

    add(bronze(spark, event(1), event(1), event(2)), source)
    assert run() == [1, 2]
    # A copy in a later batch, within the delay.
    add(bronze(spark, event(2), event(3)), source)
    assert run() == [1, 2, 3]


def test_upsert_equals_batch(spark, tmp_path):
    source, table, cp = (str(tmp_path / n) for n in ("in", "fact", "cp"))
    start = datetime(2024, 1, 15)
    all_rows = []
    for batch in range(3):
        part = [
            event(
                i,
                created_at=start + timedelta(hours=i * 5 + batch),
                ingested_at=start + timedelta(days=10 + batch),
                actor_login=f"b{batch}",
            )
            for i in range(batch, 12 - batch)
        ]
        all_rows += part
        df = bronze(spark, *part, part[0]).withColumn("date_key", date_key("created_at"))
        add(df, source)
        for _ in range(2):
            stream = spark.readStream.schema(df.schema).parquet(source)
            upsert_stream(stream, table, cp, df.schema).awaitTermination()
    got = current(spark, table, df.schema).select("event_id", "created_at", "actor_login", "date_key")
    want = silver.stg_events(bronze(spark, *all_rows)).withColumn("date_key", date_key("created_at"))
    assert rows(got) == rows(want.select("event_id", "created_at", "actor_login", "date_key"))


def test_volume_equals_batch_and_late_rows_are_dropped(spark, tmp_path):
    source, table, cp = (str(tmp_path / n) for n in ("in", "volume", "cp"))

    def run():
        stream = spark.readStream.schema(EVENT_COLUMNS).parquet(source)
        volume_to_table(stream, table, cp).awaitTermination()
        return {(r["date_key"], r["event_hour"]): r["event_count"] for r in current(spark, table, VOLUME_SCHEMA).collect()}

    first = [event(i, created_at=ts(f"2024-01-15T{10 + i // 3:02d}:{i:02d}:00")) for i in range(15)]
    add(bronze(spark, *first), source)
    batch = marts.hourly_volume(bronze(spark, *first).withColumn("date_key", date_key("created_at"))).collect()
    assert run() == {(r["date_key"], r["event_hour"]): r["event_count"] for r in batch}
    # Newest is 14:14, so hours that ended by 12:14 are closed.
    add(bronze(spark, event(90, created_at=ts("2024-01-15T10:30:00")), event(91, created_at=ts("2024-01-15T13:30:00"))), source)
    got = run()
    assert got[(20240115, 10)] == 3 and got[(20240115, 13)] == 4


def test_append_mode_leaves_the_newest_window_open(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    add(bronze(spark, *[event(i, created_at=ts(f"2024-01-15T{10 + i}:00:00")) for i in range(6)]), source)
    stream = hourly_volume_stream(spark.readStream.schema(EVENT_COLUMNS).parquet(source))
    stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r["event_hour"] for r in spark.read.parquet(out).filter(F.col("event_count") > 0).collect()) == [10, 11, 12]


def test_stream_and_batch_share_all_tables(spark, tmp_path):
    from datetime import datetime

    from hourlake.plans import ingest
    from hourlake.sources.landing import hour_range

    landing, out, cp, log, bad = (str(tmp_path / n) for n in ("landing", "bronze", "cp", "log", "bad"))
    land(landing, "2024-01-15-5.json.gz", [line(1), "{bad", "", line(2, "WatchEvent")])
    stream = lambda: stream_to_bronze(spark, landing, out, cp, TYPES, run_log=log, quarantine=bad).awaitTermination()
    stream()
    hours = hour_range(spark, datetime(2024, 1, 15, 5), datetime(2024, 1, 15, 6))
    land(landing, "2024-01-15-6.json.gz", [line(3)])
    first = ingest.ingest_hours(spark, landing, out, log, hours, event_types=TYPES, quarantine=bad).collect()
    assert [r["status"] for r in first] == ["skipped", "success"]
    stream()  # takes the batch's hour again, without doubling it
    assert sorted(r["event_id"] for r in read_bronze(spark, out).collect()) == [1, 3]
    assert [r["raw"] for r in spark.read.parquet(bad).collect()] == ["{bad"]
    runs = {(r["hour_processed"].hour, r["rows_read"], r["rows_written"], r["malformed_rows"]) for r in ingest.read_run_log(spark, log).collect()}
    assert runs == {(5, 3, 1, 1), (6, 1, 1, 0)}


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    from hourlake.plans import ingest
    from hourlake.streaming.bronze import ingest_batch

    out, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    names = ["2024-01-15-5.json.gz", "2024-01-15-5.json.gz/part-2.gz"]
    lines = spark.createDataFrame([(line(1), names[0]), (line(2), names[1])], "value string, source_file string")
    lines = lines.withColumn("file_hour", F.lit("2024-01-15 05:00:00").cast("timestamp_ntz"))
    part = lambda n: ingest.classify_lines(lines.filter(F.col("source_file") == n), TYPES)
    for n, b in ((names[0], "a"), (names[1], "b"), (names[1], "b")):
        ingest_batch(part(n), b, out, log)
    assert sorted(r["event_id"] for r in read_bronze(spark, out).collect()) == [1, 2]
    assert ingest.read_run_log(spark, log).count() == 2


def test_unreadable_files_do_not_stop_the_stream(spark, tmp_path):
    landing, out, cp, log, bad = (str(tmp_path / n) for n in ("landing", "bronze", "cp", "log", "bad"))
    ids = lambda: sorted(r[0] for r in read_bronze(spark, out).select("event_id").collect())
    run = lambda: stream_to_bronze(spark, landing, out, cp, TYPES, run_log=log, quarantine=bad).awaitTermination()
    land(landing, "2024-01-15-5.json.gz", [line(1), "{bad"])
    land(landing, "2024-01-15-6.json.gz", [line(i) for i in range(100, 3000)])
    whole = open(f"{landing}/2024-01-15-6.json.gz", "rb").read()
    open(f"{landing}/2024-01-15-6.json.gz", "wb").write(whole[:-20])
    open(f"{landing}/2024-01-15-7.json.gz", "wb").write(b"no gzip at all")
    land(landing, "2024-01-15-8.json.gz", [line(2)])
    run()
    assert ids() == [1, 2]
    runs = ingest.read_run_log(spark, log)
    got = {r["hour_processed"].hour: (r["status"], (r["error_message"] or "").split()[0:1]) for r in runs.collect()}
    assert got == {5: ("success", []), 6: ("failed", ["truncated"]), 7: ("failed", ["corrupt"]), 8: ("success", [])}
    # the stream goes on, and a batch takes the failed hours when their files are whole
    land(landing, "2024-01-15-9.json.gz", [line(3)])
    run()
    assert ids() == [1, 2, 3]
    open(f"{landing}/2024-01-15-6.json.gz", "wb").write(whole)
    hours = hour_range(spark, datetime(2024, 1, 15, 5), datetime(2024, 1, 15, 9))
    states = {r["hour"].hour: r["status"] for r in ingest.ingest_hours(spark, landing, out, log, hours, event_types=TYPES).collect()}
    assert states == {5: "skipped", 6: "success", 7: "failed", 8: "skipped", 9: "skipped"}
    assert len(ids()) == 3 + 2900


def test_a_micro_batch_of_only_unreadable_files(spark, tmp_path):
    landing, out, cp, log = (str(tmp_path / n) for n in ("landing", "bronze", "cp", "log"))
    os.makedirs(landing)
    open(f"{landing}/2024-01-15-7.json.gz", "wb").write(b"no gzip at all")
    for _ in range(2):
        stream_to_bronze(spark, landing, out, cp, TYPES, run_log=log).awaitTermination()
    assert [r["status"] for r in ingest.read_run_log(spark, log).collect()] == ["failed"]
    assert read_bronze(spark, out).count() == 0


def test_late_rows_come_out_at_the_side(spark, tmp_path):
    source, table, side, cp = (str(tmp_path / n) for n in ("in", "volume", "late", "cp"))
    schema = bronze(spark, event(1)).schema

    def run():
        volume_and_late_rows(spark.readStream.schema(schema).parquet(source), table, side, cp, pieces=3).awaitTermination()
        late = late_rows(spark, side, schema)
        streamed = stored_volume(spark, table)
        return rows(streamed), sorted(r["event_id"] for r in late.collect()), rows(recovered_volume(streamed, late))

    def batch(*events):
        return rows(marts.hourly_volume(bronze(spark, *events).withColumn("date_key", date_key("created_at"))))

    first = [event(i, created_at=ts(f"2024-01-15T{10 + i // 3:02d}:{i:02d}:00"), repo_id=None if i % 4 else 7) for i in range(15)]
    add(bronze(spark, *first), source)
    assert run() == (batch(*first), [], batch(*first))
    # the newest is 14:14, so hours that ended by 12:14 are closed
    second = [event(90, created_at=ts("2024-01-15T10:30:00"), pr_number=2**31 - 1), event(91, created_at=ts("2024-01-15T13:30:00")), event(2**60 + 1, created_at=ts("2024-01-14T00:00:00"))]
    add(bronze(spark, *second), source)
    streamed, late, whole = run()
    assert streamed == batch(*first, second[1]) and late == [90, 2**60 + 1] and whole == batch(*first, *second)
    kept = {r["event_id"]: r for r in late_rows(spark, side, schema).collect()}
    assert kept[90].asDict() == bronze(spark, second[0]).first().asDict()
    assert run() == (streamed, late, whole)


def test_late_rows_need_no_setting_of_the_session(spark, tmp_path):
    """A session with Spark's default state store, as any caller may have."""
    name = "spark.sql.streaming.stateStore.providerClass"
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    source, table, side, cp = (str(tmp_path / n) for n in ("in", "volume", "late", "cp"))
    add(bronze(spark, event(1), event(2, created_at=ts("2024-01-15T18:00:00"))), source)
    before = spark.conf.get(name)
    spark.conf.set(name, plain)
    try:
        for late in ([], [3]):
            volume_and_late_rows(spark.readStream.schema(EVENT_COLUMNS).parquet(source), table, side, cp, pieces=2).awaitTermination()
            assert spark.conf.get(name) == plain
            assert [r["event_id"] for r in late_rows(spark, side, EVENT_COLUMNS).collect()] == late
            add(bronze(spark, event(3)), source)
    finally:
        spark.conf.set(name, before)
