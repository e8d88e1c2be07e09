"""Point-in-time join on a larger copy of the events table, evenly spread and skewed.

``python tools/scale_pit.py <sf_dir> <copies>``: every copy gets its own users, except that in the
skewed run a third of all rows (events and versions alike) belong to a single user.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import hourlake  # noqa: E402
from hourlake.operators.asof import point_in_time_join  # noqa: E402
from hourlake.operators.scd import scd2_from_history  # noqa: E402
from hourlake.sources.scratch import written  # noqa: E402


def main() -> None:
    sf_dir, copies = sys.argv[1], int(sys.argv[2])
    spark = (
        hourlake.builder("scale")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    one = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    many = one.repartition(8).withColumn("c", copy).select(
        (F.col("event_id") * copies + F.col("c")).alias("event_id"),
        (F.col("user_id") * copies + F.col("c")).alias("user_id"),
        "event_type",
        (F.col("ts") + F.make_dt_interval(secs=F.col("c").cast("decimal(18,6)"))).alias("ts"),
    )
    skewed = many.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    for label, rows in (("even", many), ("skewed", skewed)):
        events = written(rows, "events")
        start = time.perf_counter()
        dim = written(
            scd2_from_history(events, "user_id", ["event_type"], "ts", ["event_id"], heavy_rows=500_000).drop("event_id"), "dim"
        )
        print(label, "versions", dim.count(), f"{time.perf_counter() - start:.1f}s", flush=True)
        # The event type is what the version says, so every row can be checked.
        fact = events.withColumnRenamed("event_type", "own")
        for strategy in ("window", "range"):
            if (label, strategy) == ("skewed", "range"):
                continue  # every event of the heavy user would meet every one of its versions
            start = time.perf_counter()
            joined = point_in_time_join(fact, dim, "user_id", "ts", strategy=strategy, heavy_rows=500_000)
            n, right = joined.agg(F.count("*"), F.count_if(F.col("own") == F.col("event_type"))).first()
            print(label, strategy, "rows", n, "right", right, f"{time.perf_counter() - start:.1f}s", flush=True)


if __name__ == "__main__":
    main()
