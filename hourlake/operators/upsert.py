"""Incremental maintenance of a keyed, partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourlake.functions.time import ntz
from hourlake.operators.membership import holders
from hourlake.sources.manifest import current, folder_name, key_index, publish_partitions
from hourlake.sources.scratch import written


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing equal keys and the rest appended."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates)


def high_water(target: DataFrame, col: str = "ingested_at") -> datetime:
    """Newest ``col`` already in the target; an empty target gives 1900-01-01."""
    top = target.agg(F.max(col)).first()[0]
    return top if top is not None else datetime(1900, 1, 1)


def newer_than(src: DataFrame, target: DataFrame, col: str = "ingested_at") -> DataFrame:
    """Source rows past the target's high-water mark.

    The mark is one value and becomes a literal, so the filter reaches the Parquet scan.
    """
    return src.filter(F.col(col) > ntz(high_water(target, col)))


def unconsumed(src: DataFrame, ledger: DataFrame) -> DataFrame:
    """Source rows of batches that the ledger does not list.

    Unlike a high-water mark this does not lose a batch that was stamped early but published late.
    """
    return src.join(ledger.select("source_file", "ingested_at"), ["source_file", "ingested_at"], "left_anti")


def batches(src: DataFrame) -> DataFrame:
    """Ledger rows for the batches in ``src`` (one per file and ingest, not per event)."""
    return src.select("source_file", "ingested_at").distinct()


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition: str,
    schema,
    before_write: Callable[[list], None] | None = None,
) -> list:
    """Upsert into a table with a manifest, partitioned by ``partition``; returns the rewritten partitions.

    Only partitions that receive rows, or hold the old version of an updated key, are rewritten: a
    correction that moves a row to another partition rewrites both. Old versions are looked for only where
    the table's key index says that one of the updated keys may be; other partitions are not read. All
    partitions change at once. ``before_write`` is told which partitions are about to change.

    Applying the same updates again changes nothing.
    """
    updates = written(updates, "upsert-in")
    given = updates.select(partition).distinct()
    found = may_hold(spark, path, updates, keys, partition)
    target = current(spark, path, schema, only=[folder_name(spark, partition, v) for v in found])
    hit = target.join(updates.select(*keys), list(keys), "left_semi").select(partition)
    # One value per touched partition (calendar dates here), not per row.
    touched = [r[0] for r in given.unionByName(hit).distinct().collect()]
    if not touched:
        return []
    if before_write is not None:
        before_write(touched)
    target = current(spark, path, schema, only=[folder_name(spark, partition, v) for v in touched])
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    publish_partitions(kept.unionByName(updates.select(*kept.columns)), path, partition, touched, keys)
    return sorted(touched, key=lambda v: (v is not None, v))


def may_hold(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition: str) -> list:
    """Values of ``partition`` where one of the updated keys may be stored, by the table's key index alone.

    Partitions that were published without an index are always among them.
    """
    kind = updates.schema[partition].dataType.simpleString()
    index, sizes, unknown = key_index(spark, path, partition, kind)
    values = [r[0] for r in holders(index, sizes, updates, keys, partition).collect()] if sizes else []
    if unknown:
        plain = {folder_name(spark, partition, v): v for v in _values(current(spark, path, updates.select(partition).schema, only=unknown), partition)}
        values += [plain[f] for f in unknown if f in plain]
    return values


def _values(rows: DataFrame, partition: str) -> list:
    return [r[0] for r in rows.select(partition).distinct().collect()]


def replace_partitions(rows: DataFrame, path: str, partition: str, values: list) -> None:
    """Make ``rows`` the whole content of the listed partitions, all at once; no other partition is touched."""
    publish_partitions(rows, path, partition, values)
