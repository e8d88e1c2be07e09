from __future__ import annotations

import gzip
import json
import os
from datetime import datetime, timedelta

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from hourlake.plans import ingest
from hourlake.sources.bronze import read_bronze
from hourlake.sources.gzip_check import data_source, gzip_errors
from hourlake.sources.landing import hour_name, hour_of_path, hour_range

TYPES = ("PushEvent", "PullRequestEvent")
H = datetime(2025, 3, 8, 21)


def line(number, kind="PushEvent", **fields):
    """A line of the feed, made from its number: five people work on three projects, an event every seven seconds.

    ``fields`` take the place of whole top-level values.
    """
    seed = number if isinstance(number, int) else 0
    project = seed % 3
    made = {
        "org": {"id": 70 + project},
        "repo": {"id": 800 + project, "name": f"Guild{project}/tool-{project}"},
        "actor": {"login": ("ines", "jo", "kim", "lou", "max")[seed % 5], "id": 40 + seed % 5},
        "created_at": f"{H + timedelta(seconds=7 * seed % 3600):%Y-%m-%dT%H:%M:%SZ}",
        "id": str(number),
    }
    return json.dumps({"type": kind} | made | fields)


def classify(spark, *lines):
    df = spark.createDataFrame([(ln, "f") for ln in lines], "value string, source_file string")
    return ingest.classify_lines(df, TYPES, H + timedelta(hours=2))


def counters(df):
    r = ingest.line_counters(df).first()
    return r["rows_read"], r["rows_kept"], r["filtered_rows"], r["malformed_rows"]


def test_outcome_of_generated_lines(spark):
    """Sixty lines, each spoilt in the way its number says; outcome, values and quarantined text follow from it."""
    opened = {"action": "opened", "pull_request": {"number": 31}}
    spoilt = [
        ("kept", lambda n: line(n)),
        ("kept", lambda n: line(n, "PullRequestEvent", payload=opened)),
        ("filtered", lambda n: line(n, ("ForkEvent", "pushevent", None)[n % 3])),
        ("filtered", lambda n: line(n, "GollumEvent", actor=None, created_at="never")),
        ("malformed", lambda n: line(n)[: -1 - n]),
        ("malformed", lambda n: line(n, created_at="never")),
    ]
    lines = {n: (outcome, made(n)) for n in range(60) for outcome, made in [spoilt[n % 6]]}
    df = classify(spark, *[text for _, text in lines.values()])
    assert counters(df) == (60, 20, 20, 20)
    got = {r["event_id"]: r for r in df.filter("event_id is not null").collect()}
    assert all(r["outcome"] == lines[n][0] for n, r in got.items())
    assert {n for n, (outcome, _) in lines.items() if outcome == "kept"} <= set(got)
    for n in range(1, 60, 6):
        r = got[n]
        assert (r["event_type"], r["action"], r["pr_number"], r["repo_id"], r["org_id"]) == ("PullRequestEvent", "opened", 31, 800 + n % 3, 70 + n % 3)
        assert (r["actor_id"], r["created_at"], r["repo_name"]) == (40 + n % 5, H + timedelta(seconds=7 * n), f"Guild{n % 3}/tool-{n % 3}")
    # Quarantine keeps the text as it came.
    lost = [r["raw"] for r in df.filter("outcome = 'malformed'").collect()]
    assert sorted(lost) == sorted(text for outcome, text in lines.values() if outcome == "malformed")


def test_blank_lines_are_not_read(spark):
    assert counters(classify(spark, line(1), "", "  \t ", "\r")) == (1, 1, 0, 0)


def test_excluded_type_is_filtered_before_validation(spark):
    assert counters(classify(spark, '{"type":"WatchEvent"}', '{"id":"x"}')) == (2, 0, 2, 0)


@pytest.mark.parametrize("bad", ["[1]", "null", "1", "{}]", "[{}", '"s"', '[{"id":"1","type":"PushEvent"}]', "{'id':'1'}"])
def test_non_object_line_is_malformed(spark, bad):
    assert counters(classify(spark, bad)) == (1, 0, 0, 1)


@pytest.mark.parametrize("tail", [" x", "{}", ",{}", "}", "]", ",\"z\":1", "]}", "]} trailing", "]},{\"x\":[1", "]", "],[{}", ",{\"z\":\"0\"}]"])
def test_text_after_the_object_is_malformed(spark, tail):
    assert counters(classify(spark, line(1) + tail)) == (1, 0, 0, 1)


def test_last_duplicate_key_wins(spark):
    df = classify(spark, line(1)[:-1] + ',"type":"PullRequestEvent"}')
    assert [r["event_type"] for r in df.collect()] == ["PullRequestEvent"]


def test_invalid_utf8_is_malformed(spark):
    df = spark.createDataFrame([(bytearray(line(1).encode()),), (bytearray(line(2).encode() + b"\xff"),)], "b binary")
    lines = df.select(F.expr("cast(b as string)").alias("value"), F.lit("f").alias("source_file"))
    assert counters(ingest.classify_lines(lines, TYPES, H)) == (2, 1, 0, 1)


@pytest.mark.parametrize(
    ("text", "utc"),
    [
        ("2024-01-15T12:00:00Z", "2024-01-15T12:00:00"),
        ("2024-01-15T12:00:00", "2024-01-15T12:00:00"),
        ("2024-01-15T12:00:00+05:30", "2024-01-15T06:30:00"),
        ("2024-01-15T12:00:00.250000-0230", "2024-01-15T14:30:00.250000"),
        ("2024-01-15T00:30:00+01:00", "2024-01-14T23:30:00"),
        ("2024-01-15", "2024-01-15T00:00:00"),
        ("yesterday", None),
        ("1705320000", None),
    ],
)
def test_timestamps_become_utc(spark, text, utc):
    got = classify(spark, line(1, created_at=text)).select("created_at", "outcome").first()
    assert got["created_at"] == (ts(utc) if utc else None)
    assert got["outcome"] == ("kept" if utc else "malformed")


def test_required_and_optional_fields(spark):
    df = classify(
        spark,
        line(1, actor={"id": 1, "login": None}),
        line(2, actor="ines"),
        line("x"),
        line(4, payload={"issue": {"number": 5_000_000_000}}),
        line(5, repo={"id": "not a number", "name": "a/b"}),
        line(6, repo="text", payload="text"),
        line(7, repo=None, org=None, payload=None),
    )
    got = {r["event_id"]: r for r in df.collect()}
    assert {i for i, r in got.items() if r["outcome"] == "malformed"} == {1, 2, None}
    assert got[4]["issue_number"] is None and got[4]["nulled_fields"] == 1
    assert got[5]["repo_id"] is None and got[5]["repo_name"] == "a/b" and got[5]["nulled_fields"] == 1
    assert got[6]["repo_id"] is None and got[6]["outcome"] == "kept"
    assert got[7]["nulled_fields"] == 0


def test_hour_names_are_not_padded(spark):
    hours = [datetime(2024, 1, 15, h) for h in range(24)]
    names = [hour_name(h) for h in hours]
    assert names[5] == "2024-01-15-5.json.gz" and names[15] == "2024-01-15-15.json.gz"
    back = spark.createDataFrame(list(zip(names, hours)), "n string, h timestamp_ntz")
    assert back.filter(hour_of_path(F.col("n")) == F.col("h")).count() == 24


def test_other_hours_are_not_listed(spark, tmp_path, monkeypatch):
    from hourlake.sources import landing as zone

    asked = []
    monkeypatch.setattr(zone, "path_exists", lambda s, p: asked.append(p) or False)
    assert zone.hour_path(spark, "/zone", H) is None
    assert asked == ["/zone/2025-03-08-21.json.gz", "/zone/hour_file=2025-03-08-21.json.gz"]


def test_hour_range(spark):
    got = [r[0] for r in hour_range(spark, H, H.replace(hour=23)).orderBy("hour").collect()]
    assert got == [H.replace(hour=h) for h in (21, 22, 23)]
    with pytest.raises(ValueError):
        hour_range(spark, H.replace(minute=1), H)
    with pytest.raises(ValueError):
        hour_range(spark, H, H.replace(hour=20))


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing, self.bronze, self.log, self.bad = (f"{root}/{n}" for n in ("landing", "bronze", "log", "bad"))
        os.makedirs(self.landing)

    def put(self, hour, lines, cut=0, part=None):
        name = f"{self.landing}/{hour:%Y-%m-%d}-{hour.hour}.json.gz"
        if part is not None:
            os.makedirs(name, exist_ok=True)
            name = f"{name}/part-{part}.gz"
        data = gzip.compress(("\n".join(lines) + "\n").encode())
        with open(name, "wb") as f:
            f.write(data[: len(data) - cut])

    def run(self, start=H, end=H, **kw):
        out = ingest.ingest_hours(
            self.spark, self.landing, self.bronze, self.log, hour_range(self.spark, start, end),
            event_types=TYPES, quarantine=self.bad, **kw,
        )
        return {r["hour"]: r for r in out.collect()}

    def ids(self):
        return sorted(r[0] for r in read_bronze(self.spark, self.bronze).select("event_id").collect())

    def files(self):
        found = {}
        for d, _, names in os.walk(self.bronze):
            for n in names:
                if n.endswith(".parquet"):
                    found[f"{d}/{n}"] = os.stat(f"{d}/{n}").st_mtime_ns
        return found


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def test_rerun_is_skipped_and_files_stay(lake):
    lake.put(H, [line(1), line(2)])
    first = lake.run()[H]
    assert (first["status"], first["rows_read"], first["rows_kept"]) == ("success", 2, 2)
    assert first["bytes_written"] > 0
    before = lake.files()
    assert lake.run()[H]["status"] == "skipped"
    assert lake.files() == before
    assert ingest.read_run_log(lake.spark, lake.log).count() == 1


def test_force_replaces(lake):
    lake.put(H, [line(1)])
    lake.run()
    lake.put(H, [line(2), line(3)])
    assert lake.run(force=True)[H]["rows_kept"] == 2
    assert lake.ids() == [2, 3]
    lake.put(H, [line(4, "WatchEvent")])
    assert lake.run(force=True)[H]["rows_kept"] == 0
    assert lake.ids() == []


def test_bad_hours_do_not_affect_others(lake):
    hours = [H.replace(hour=h) for h in (20, 21, 22, 23)]
    lake.put(hours[0], [line(1), "{broken"])
    lake.put(hours[1], [line(i) for i in range(100, 5000)], cut=12)
    lake.put(hours[3], [line(9, "WatchEvent")])
    out = lake.run(hours[0], hours[3])
    assert [out[h]["status"] for h in hours] == ["success", "failed", "failed", "success"]
    assert "truncated" in out[hours[1]]["error_message"]
    assert "not found" in out[hours[2]]["error_message"]
    assert lake.ids() == [1]
    assert lake.spark.read.parquet(lake.bad).select("raw").first()[0] == "{broken"
    # An hour that kept nothing is done; only the failed ones are tried again.
    lake.put(hours[1], [line(2)])
    lake.put(hours[2], [line(3)])
    again = lake.run(hours[0], hours[3])
    assert [again[h]["status"] for h in hours] == ["skipped", "success", "success", "skipped"]
    assert lake.ids() == [1, 2, 3]
    log = ingest.read_run_log(lake.spark, lake.log)
    assert log.count() == 6 and log.select("run_id").distinct().count() == 6
    assert log.filter("status = 'failed'").count() == 2


def test_hour_in_parts_fails_as_a_whole(lake):
    lake.put(H, [line(1)], part=0)
    lake.put(H, [line(i) for i in range(100, 3000)], part=1, cut=20)
    assert lake.run()[H]["status"] == "failed"
    assert lake.ids() == []
    lake.put(H, [line(2)], part=1)
    assert lake.run()[H]["rows_kept"] == 2
    assert lake.ids() == [1, 2]


def test_partition_follows_the_file_hour(lake):
    lake.put(H, [line(1, created_at="2025-03-07T23:59:59Z")])
    lake.run()
    got = read_bronze(lake.spark, lake.bronze).select("event_date", "hour").first()
    assert (str(got[0]), got[1]) == ("2025-03-08", "21")
    assert os.path.isdir(f"{lake.bronze}/event_date=2025-03-08/hour=21")


def test_corrupt_gzip_is_recognised(spark, tmp_path):
    whole = gzip.compress(b"abc\n" * 5000)
    files = {
        "ok.gz": whole,
        "two.gz": whole + whole,
        "cut.gz": whole[:-9],
        "flip.gz": whole[:40] + bytes([whole[40] ^ 255]) + whole[41:],
        "text.gz": b"plain text",
        "empty.gz": b"",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    bad = ingest.unreadable_files(spark, [str(tmp_path / n) for n in files]).collect()
    assert sorted(os.path.basename(r["path"]) for r in bad) == ["cut.gz", "flip.gz", "text.gz"]


@pytest.mark.parametrize("piece", [1, 7, 1 << 10])
def test_files_are_verified_in_pieces(spark, tmp_path, piece):
    members = b"".join(gzip.compress(os.urandom(50) * 40) for _ in range(3))
    want = {"good.gz": None, "cut.gz": "truncated", "member.gz": None, "flip.gz": "corrupt", "tail.gz": "corrupt", "none.gz": None}
    data = {"good.gz": members[: len(members)], "cut.gz": members[:-1], "member.gz": gzip.compress(b""), "tail.gz": members + b"more", "none.gz": b""}
    data["flip.gz"] = members[:30] + bytes([members[30] ^ 255]) + members[31:]
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {os.path.basename(r["path"]): r["error"] for r in gzip_errors(spark, [f"file:{tmp_path}/{n}" for n in data], piece).collect()}
    assert {n: e and e.split()[0] for n, e in got.items()} == want
    assert gzip_errors(spark, []).count() == 0


def test_verifying_needs_little_memory(tmp_path):
    """Half a gigabyte of text from a small file, in one process."""
    import tracemalloc

    with gzip.open(tmp_path / "big.gz", "wb", compresslevel=1) as f:
        for _ in range(512):
            f.write(b"\0" * (1 << 20))
    reader = data_source()(options={"files": json.dumps([str(tmp_path / "big.gz")])}).reader(None)
    tracemalloc.start()
    assert [e for p in reader.partitions() for _, e in reader.read(p)] == [None]
    assert tracemalloc.get_traced_memory()[1] < 16 << 20


def test_backfill_summary(spark):
    df = spark.createDataFrame([("success",), ("success",), ("failed",)], "status string")
    assert rows(ingest.backfill_summary(df)) == [("failed", 1), ("success", 2)]
