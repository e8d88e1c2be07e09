"""Partitioned tables whose changes become visible all at once.

Every change writes the partitions it touches into a folder of its own and then one small file, the *manifest*, which names
the folder of every partition that the table has from then on:

    data/_change=7/date_key=20240115/part-….parquet      rows of the partitions that change 7 touched
    keys/_change=7/date_key=20240115/part-….parquet      which keys these partitions may hold (see operators.membership)
    manifest/00000000000000000007.json             {"date_key=20240115": {"change": 7, "words": 4096}, …}

Readers take the newest manifest. It appears by a rename that fails if the name is taken, so a change is there whole or not at all,
whatever dies when, and of two writers that started from the same state one fails. Folders
that no kept manifest names are left-overs, removed by ``drop_unreferenced``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from hourlake.operators.membership import bitmap, words_for

Folders = dict[str, dict]
#: Folders of changes look like a partition column, because tables are read from several of them; no column may have this name.
CHANGE = "_change"


class ConcurrentChange(RuntimeError):
    """Another writer has published a change since this one read the table."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, path))) if fs.exists(_path(spark, path)) else []


def changes(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all published changes, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/manifest") if n.endswith(".json") and n[:-5].isdigit()]


def folders(spark: SparkSession, path: str, change: int | None = None) -> Folders:
    """Partition folders of the table after a change (the newest unless given)."""
    if change is None:
        done = changes(spark, path)
        if not done:
            return {}
        change = done[-1]
    stream = _fs(spark, path).open(_path(spark, _manifest(path, change)))
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _manifest(path: str, change: int) -> str:
    return f"{path}/manifest/{change:020d}.json"


def folder_name(spark: SparkSession, partition: str, value) -> str:
    """The folder Spark writes a partition's rows to."""
    text = None if value is None else str(value)
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition, text)


def current(spark: SparkSession, path: str, schema, change: int | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The table as the newest (or a given) change left it, with a declared schema; no rows if there is none.

    ``only``: folder names to which the read is limited.
    """
    known = folders(spark, path, change)
    return _read(spark, f"{path}/data", schema, {f: known[f] for f in known if only is None or f in only})


def _read(spark: SparkSession, root: str, schema, found: Folders) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    if not found:
        return empty
    places = [f"{root}/{CHANGE}={x['change']}/{name}" for name, x in sorted(found.items())]
    return spark.read.schema(empty.schema).option("basePath", root).parquet(*places).select(*empty.columns)


def key_index(spark: SparkSession, path: str, partition: str, kind: str) -> tuple[DataFrame, list[int], list[str]]:
    """Bitmaps of all partitions that have one (``partition`` of type ``kind``, ``words, word, bits``), their sizes, and the folders without."""
    known = folders(spark, path)
    have = {f: x for f, x in known.items() if x.get("words")}
    schema = StructType.fromDDL(f"words bigint, word bigint, bits bigint, `{partition}` {kind}")
    return _read(spark, f"{path}/keys", schema, have), sorted({x["words"] for x in have.values()}), sorted(set(known) - set(have))


def publish_partitions(rows: DataFrame, path: str, partition: str, values: Sequence, keys: Sequence[str] = ()) -> int:
    """Make ``rows`` the whole content of the listed partitions, all at once; returns the change's number.

    ``rows`` may be computed from the table itself. Partitions of the list that get no row are gone afterwards, others are not
    touched. With ``keys``, what these columns hold is indexed for each partition.
    """
    spark = rows.sparkSession
    before = changes(spark, path)
    base = folders(spark, path, before[-1]) if before else {}
    used = [int(n.partition("=")[2]) for n in _names(spark, f"{path}/data") if n.startswith(f"{CHANGE}=")]
    change = max([0, *before, *used]) + 1  # left-overs of a writer that died keep their number
    target = f"{path}/data/{CHANGE}={change}"
    by_time = [c for c in ("created_at",) if c in rows.columns]
    seen = Observation()
    # Rebalancing gives files of even size: small partitions share a task, a huge one is split.
    (
        rows.hint("rebalance", partition)
        .observe(seen, F.collect_set(partition).alias("filled"))
        .sortWithinPartitions(partition, *by_time)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(partition)
        .parquet(target)
    )
    touched = {folder_name(spark, partition, v) for v in values}
    fresh = {n: {"change": change} for n in _names(spark, target) if n.startswith(f"{partition}=")}
    if not set(fresh) <= touched:
        raise ValueError(f"rows of other partitions than those listed: {sorted(set(fresh) - touched)[:3]}")
    if keys and fresh:
        _index(spark.read.schema(rows.schema).parquet(target), partition, keys, f"{path}/keys/{CHANGE}={change}", fresh, spark)
    now = {n: x for n, x in base.items() if n not in touched} | fresh
    _put(spark, path, change, now, before[-1] if before else 0)
    return change


def _index(rows: DataFrame, partition: str, keys: Sequence[str], target: str, fresh: Folders, spark: SparkSession) -> None:
    """One bitmap for each new partition, sized for its rows."""
    counts = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each touched partition
    sizes = [(r[0], words_for(r["n"], None)) for r in counts]
    for value, words in sizes:
        fresh[folder_name(spark, partition, value)]["words"] = words
    kind = rows.schema[partition].dataType.simpleString()
    sized = rows.select(*keys, partition).join(spark.createDataFrame(sizes, f"_p {kind}, _words bigint"), F.col(partition).eqNullSafe(F.col("_p")))
    bitmap(sized, keys, F.col("_words"), [partition]).write.mode("errorifexists").option("compression", "zstd").partitionBy(partition).parquet(target)


def _put(spark: SparkSession, path: str, change: int, state: Folders, base: int) -> None:
    """Publish: write the manifest aside, then give it its name, which must be free."""
    fs, final = _fs(spark, path), _path(spark, _manifest(path, change))
    done = changes(spark, path)
    if (done[-1] if done else 0) != base:
        raise ConcurrentChange(f"{path} is at change {done[-1]}, expected {base}")
    aside = _path(spark, f"{path}/manifest/_{change:020d}-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(json.dumps(state, sort_keys=True).encode())
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), options)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if fs.exists(final):
            raise ConcurrentChange(f"change {change} of {path} was published by another writer") from e
        raise


def drop_unreferenced(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` manifests and every folder that none of these names; returns how many folders went.

    Not to be called while another writer is at work: its folders are not named yet.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    done = changes(spark, path)
    fs, named = _fs(spark, path), set()
    for change in done[-keep:]:
        named |= {(f"{CHANGE}={x['change']}", name) for name, x in folders(spark, path, change).items()}
    for change in done[:-keep]:
        fs.delete(_path(spark, _manifest(path, change)), False)
    gone = 0
    for kind in ("data", "keys"):
        for version in _names(spark, f"{path}/{kind}"):
            inside = [n for n in _names(spark, f"{path}/{kind}/{version}") if "=" in n]
            idle = [n for n in inside if (version, n) not in named]
            for n in [f"/{n}" for n in idle] if len(idle) < len(inside) else [""]:
                fs.delete(_path(spark, f"{path}/{kind}/{version}{n}"), True)
            gone += len(idle)
    return gone
