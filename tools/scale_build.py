"""Bronze to gold on a larger copy of the events table: ``scale_build.py <sf_dir> <copies>``."""

from __future__ import annotations

import sys
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import hourlake  # noqa: E402
from hourlake.operators.checks import ChecksFailed  # noqa: E402
from hourlake.plans import build as plan  # noqa: E402
from hourlake.sources.bronze import partition_columns, write_bronze  # noqa: E402
from hourlake.sources.landing import hour_of_path  # noqa: E402
from hourlake.sources.scratch import scratch_path  # noqa: E402
from hourlake.sources.tables import append  # noqa: E402
from lakequeries import adapter  # noqa: E402


def main() -> None:
    sf_dir, copies = sys.argv[1], int(sys.argv[2])
    spark = (
        hourlake.builder("scale")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    base = scratch_path(spark, "scale")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(16).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    ).select(
        (F.col("event_id") * copies + F.col("c")).alias("event_id"),
        "ts",
        (F.col("user_id") * copies + F.col("c")).alias("user_id"),
        "event_type",
        "value",
        F.format_string('{"k": %d}', F.get_json_object("props", "$.k").cast("bigint") * copies + F.col("c")).alias("props"),
    ).write.parquet(f"{base}/events.parquet")
    paths = plan.LakePaths(f"{base}/lake")
    day, hour = partition_columns(hour_of_path(F.col("source_file")))
    rows = adapter.feed(spark, base).select("*", day, hour).repartition(16, "event_date", "hour")
    write_bronze(rows, paths.bronze)
    append(adapter.runs(spark, base), paths.run_log)

    for name in ("_publish", "upsert_table", "replace_partitions", "append", "written"):
        _timed(name)
    start = time.perf_counter()
    try:
        plan.build(spark, paths, datetime(2024, 1, 31), "scale")
    except ChecksFailed as e:
        print("checks failed:", e)
    print(f"build {time.perf_counter() - start:.1f}s")


def _timed(name: str) -> None:
    inner = getattr(plan, name)

    def call(*args, **kw):
        start = time.perf_counter()
        out = inner(*args, **kw)
        where = next((a for a in args if isinstance(a, str)), "")
        print(f"{name} {where.rsplit('/', 1)[-1]} {time.perf_counter() - start:.1f}s", flush=True)
        return out

    setattr(plan, name, call)


if __name__ == "__main__":
    main()
