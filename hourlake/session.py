"""Session defaults the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that make results correct and plans scale; callers may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    # Keys of a long dedupe window do not fit executor heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A partial hour must never be published, so unreadable files stay fatal.
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.files.ignoreMissingFiles": "false",
}


def builder(app_name: str = "hourlake") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b


def pin_utc(spark: SparkSession) -> None:
    """Every stored timestamp is zone-less UTC; the session has to agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
