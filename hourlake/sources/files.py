"""File listings: which files exist and how large they are, without reading them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_LISTING = "path string, length bigint"


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    """Remove partitions that are to be replaced by nothing: a dynamic overwrite leaves those alone."""
    for path in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row ``(path, length)`` per file below ``root``; no rows when there is no such folder.

    ``content`` is never selected, so only the listing is done.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], _LISTING)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )


def footprint(spark: SparkSession, zones: dict[str, str], glob: str = "*.parquet") -> DataFrame:
    """File count, bytes and MB per zone (``{zone name: root folder}``); empty zones give zeros."""
    files = None
    for zone, root in zones.items():
        f = list_files(spark, root, glob).withColumn("zone", F.lit(zone))
        files = f if files is None else files.unionByName(f)
    if files is None:
        raise ValueError("no zones given")
    names = spark.createDataFrame([(z,) for z in zones], "zone string")
    sizes = files.groupBy("zone").agg(F.count("*").alias("n"), F.sum("length").alias("b"))
    n_bytes = F.coalesce(F.col("b"), F.lit(0))
    return names.join(sizes, "zone", "left").select(
        "zone",
        F.coalesce(F.col("n"), F.lit(0)).alias("file_count"),
        n_bytes.alias("bytes"),
        (n_bytes / F.lit(1024.0 * 1024.0)).alias("mb"),
    )


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet at ``path`` with a declared schema, or no rows when nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
