"""Table sinks and scans on plain Parquet folders.

Three kinds of table:

* *rebuilt* tables (silver, dimensions, marts): every publish writes a new ``v=<n>`` folder; the
  newest folder with a ``_SUCCESS`` marker is the table, so readers never see partial output and a
  table can be rebuilt from itself;
* *appended* tables (run log, check results): ``append`` plus an occasional ``compact``;
* *changed* tables (the fact, per-day marts): partitioned, see ``hourlake.sources.manifest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourlake.sources.files import read_or_empty


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, path: str, complete_only: bool = True) -> list[int]:
    """Version numbers below a table folder, oldest first."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith("v=") or not name[2:].isdigit():
            continue
        marker = spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
        if not complete_only or fs.exists(marker):
            found.append(int(name[2:]))
    return sorted(found)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of the table and return that version's folder."""
    spark = df.sparkSession
    taken = versions(spark, path, complete_only=False)
    target = f"{path}/v={taken[-1] + 1 if taken else 1}"
    w = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def published(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete version of a table, or no rows when it was never published."""
    done = versions(spark, path)
    return read_or_empty(spark, f"{path}/v={done[-1]}" if done else f"{path}/v=0", schema)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` complete versions (a reader may still hold the last)."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    old = versions(spark, path)[:-keep]
    for n in old:
        fs, p = _fs(spark, f"{path}/v={n}")
        fs.delete(p, True)
    return len(old)


def append(df: DataFrame, path: str) -> None:
    """Add rows to an appended table."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def compacted(df: DataFrame, rows_per_file: int = 1_000_000) -> DataFrame:
    """Same rows in few files: publish the result to replace many small appends."""
    n = df.count()
    return df.repartition(max(1, -(-n // rows_per_file)))
