"""Cleans ``documents`` and packs them: each stage works on all that the one before it kept.

A stage is written as Parquet below ``spark.checkpoint.dir`` and read again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourlake.llm import decontaminate, line_dedup, packing, quality_rules, queries, simhash
from hourlake.sources.scratch import written

#: SQL can't express the stages; see tests/llm for the brute-force versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go."""
    queries.importable(spark)
    return quality_rules.passing_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share are cut from the texts."""
    return line_dedup.without_frequent_lines(docs, least_docs=10, least_chars=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.first_of_each(docs, size=4, distance=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes full sequences with the corpus mixture of sources."""
    return packing.pack(docs, queries.vocabulary_path(), length=1024)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontaminate", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
