"""One query per operator over the whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from hourlake.llm import (
    centroid_clustering,
    decontaminate,
    jaccard_join,
    line_dedup,
    maxent_lm,
    packing,
    prefix_trie,
    quality_rules,
    simhash,
    substring_dedup,
    suffix_array_dedup,
    toxicity,
    url_filter,
)
from hourlake.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (a shared install, else use ``--py-files``)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


#: Parquet reads a column of a row group in pieces of some megabytes, and not at once through a buffer of that size outside the heap.
IN_PIECES = {"parquet.hadoop.vectored.io.enabled": "false"}


def table(spark: SparkSession, sf_dir: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    pin_utc(spark)
    importable(spark)
    return spark.read.options(**(options or {})).parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """Place of the public vocabulary the packing query uses; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query
def op1_suffix_array_dedup(spark, sf_dir):
    return suffix_array_dedup.suffix_array_dedup_report(table(spark, sf_dir, "documents"), size=200)


@query
def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup_report(table(spark, sf_dir, "documents"), size=13)


@query
def op3_quality_rules(spark, sf_dir):
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


@query
def op4_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents", IN_PIECES), table(spark, sf_dir, "benchmark"))


@query
def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query
def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(), length=1024)


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.judged(table(spark, sf_dir, "pages"))


@query
def op8_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), size=4, distance=4)


@query
def op9_maxent_lm(spark, sf_dir):
    return maxent_lm.lm_scores(table(spark, sf_dir, "documents"))


@query
def op10_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)


@query
def op11_centroid_clustering(spark, sf_dir):
    return centroid_clustering.clustered(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, numerator=90, denominator=100)
