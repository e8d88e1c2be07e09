"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and
cores. Every query runs once to warm up and is then timed once, to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import hourlake  # noqa: E402
from lakequeries.catalog import QUERIES  # noqa: E402

HEADLINES = (
    "i04_flatten",
    "i08_line_counters",
    "v01_dedupe_latest",
    "v01_latest_shipment",
    "v05_daily_latest",
    "v07_stg_events",
    "g02_scd2_history",
    "g04_scd2_dimension",
    "g07_point_in_time_join",
    "g07b_asof_window",
    "g09_upsert",
    "g10_fact_events",
    "g11_open_merge_pairs",
    "g12_elapsed_hours",
    "m01_daily_activity",
    "m02_lifecycle_percentiles",
    "m02b_line_price_percentiles",
    "m04_hourly_volume",
    "m05_health_snapshot",
    "m08_failure_streak",
    "q01_unique",
    "q04_relationships",
    "q08_anomaly",
    "q09_severity",
    "a01_activity_named",
    "a04_top20",
    "p01_type_distribution",
    "p03_field_presence",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        hourlake.builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
