"""Shared scratch space and lineage cuts.

Executors may be lost at any time, so intermediate results that must not be recomputed are written
to the folder the cluster shares (``spark.checkpoint.dir``), never to executor or driver disks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this session; a temp folder only for a local master."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="hourlake-")
    spark.conf.set(SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the scratch folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/hourlake/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote to scratch; DataFrames that read it become invalid."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once to scratch and read back: parsed once, lineage cut."""
    path = scratch_path(df.sparkSession, label)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
