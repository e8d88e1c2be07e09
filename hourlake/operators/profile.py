"""Profiling of raw event lines (a column ``value`` of JSON text), over the whole input."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourlake.sources.files import list_files
from hourlake.sources.scratch import scratch_path

# The fields whose presence is measured by default.
CANDIDATE_FIELDS = (
    "id",
    "type",
    "created_at",
    "actor.id",
    "actor.login",
    "repo.id",
    "repo.name",
    "org.id",
    "payload.action",
    "payload.pull_request.number",
    "payload.pull_request.merged",
    "payload.issue.number",
    "payload.commits",
)


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows and percentage per value of ``col`` (NULL is a value)."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total")).scalar()
    return counts.select(col, "n", (F.lit(100.0) * F.col("n") / total).alias("pct"))


def with_type(lines: DataFrame) -> DataFrame:
    return lines.withColumn("type", F.get_json_object("value", "$.type"))


def type_distribution(lines: DataFrame) -> DataFrame:
    return distribution(with_type(lines), "type")


def _nest(paths: Sequence[str]) -> dict:
    tree: dict = {}
    for p in paths:
        node = tree
        for part in p.split("."):
            node = node.setdefault(part, {})
    return tree


def _as_type(tree: dict) -> T.DataType:
    if not tree:
        return T.StringType()
    return T.StructType([T.StructField(k, _as_type(v)) for k, v in tree.items()])


def field_presence(lines: DataFrame, paths: Sequence[str] = CANDIDATE_FIELDS) -> DataFrame:
    """``path, present, total, pct`` per dotted path; JSON null counts as absent.

    Every line is parsed once, with a schema made of just the asked-for paths.
    """
    doc = lines.select(F.from_json("value", _as_type(_nest(paths))).alias("d"))
    counts = doc.agg(
        F.count("*").alias("total"),
        *[F.count(F.col(f"d.{p}")).alias(f"p{i}") for i, p in enumerate(paths)],
    )
    rows = F.array(
        *[F.struct(F.lit(p).alias("path"), F.col(f"p{i}").alias("present")) for i, p in enumerate(paths)]
    )
    return counts.select(F.explode(rows).alias("r"), "total").select(
        "r.path",
        "r.present",
        "total",
        F.try_divide(F.lit(100.0) * F.col("r.present"), F.col("total")).alias("pct"),
    )


def key_sets(lines: DataFrame, path: str) -> DataFrame:
    """How often each set of keys occurs under a nested object; NULL where it is absent.

    ``path`` is a JSON path such as ``$.payload.pull_request`` (``$`` for the whole line).
    """
    inner = F.col("value") if path == "$" else F.get_json_object("value", path)
    keys = F.array_join(F.array_sort(F.json_object_keys(inner)), ",").alias("keys")
    return lines.select(keys).groupBy("keys").agg(F.count("*").alias("n"))


def action_distribution(lines: DataFrame, event_type: str) -> DataFrame:
    """Rows per ``payload.action`` within one event type."""
    parsed = F.from_json("value", "type string, payload struct<action string>")
    # Through a generator, so that the filter below does not parse every line a second time.
    doc = lines.select(F.explode(F.array(parsed)).alias("d"))
    return (
        doc.filter(F.col("d.type") == event_type)
        .groupBy(F.col("d.payload.action").alias("action"))
        .agg(F.count("*").alias("n"))
    )


def array_lengths(lines: DataFrame, path: str) -> DataFrame:
    """How many lines have an array of each length under a JSON path; NULL where there is none."""
    length = F.json_array_length(F.get_json_object("value", path)).alias("length")
    return lines.select(length).groupBy("length").agg(F.count("*").alias("n"))


def schema_by_type(lines: DataFrame) -> DataFrame:
    """``type, schema``: the merged schema of all lines of a type, not of one sample."""
    doc = with_type(lines).withColumn("_v", F.try_parse_json("value"))
    return doc.groupBy("type").agg(F.schema_of_variant_agg("_v").alias("schema"))


def _leaf_lister(max_depth: int | None):
    """Batch function ``(type, schema) -> (type, path, data_type)``; self-contained for workers."""
    token = re.compile(
        r"OBJECT<|ARRAY<|>|,\s*|`((?:[^`]|``)*)`:\s*|([^<>,:`\s]+):\s*|([^<>,:`]+(?:\(\d+,\s*\d+\))?)"
    )

    def leaves(schema: str) -> Iterator[tuple[str, str]]:
        # Depth is counted in nested objects, not in dots: a key may contain some.
        parents, name = [""], ""
        for m in token.finditer(schema):
            text, quoted, plain, leaf = m.group(0, 1, 2, 3)
            path = ".".join(p for p in (parents[-1], name) if p)
            if quoted is not None or plain is not None:
                name = quoted.replace("``", "`") if quoted is not None else plain
                continue
            if text == "OBJECT<":
                parents.append(path)
            elif text == "ARRAY<":
                parents.append(f"{path}[]")
            elif text == ">":
                parents.pop()
            elif leaf is not None and (max_depth is None or len(parents) - 1 <= max_depth):
                yield path, leaf.strip()
            name = ""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(t, *x) for t, s in zip(pdf["type"], pdf["schema"]) for x in leaves(s)]
            yield pd.DataFrame(rows, columns=["type", "path", "data_type"])

    return expand


def schema_tree(lines: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``type, path, data_type`` for every leaf seen in lines of that type, down to ``max_depth`` objects if given."""

    # One short schema text per event type goes to Python, not the lines.
    return schema_by_type(lines).mapInPandas(_leaf_lister(max_depth), "type string, path string, data_type string")


def form_sizes(spark: SparkSession, lines: DataFrame, projected: DataFrame) -> DataFrame:
    """Bytes of the same rows as raw text, gzip text, all-column Parquet and projected Parquet.

    Each form is written to scratch by Spark and measured from its file listing. ``ratio`` is how
    many times smaller than the raw text it is.
    """
    root = scratch_path(spark, "sizes")
    text = lines.select("value")
    text.write.text(f"{root}/raw")
    text.write.option("compression", "gzip").text(f"{root}/gzip")
    every = spark.read.json(f"{root}/raw")
    every.write.option("compression", "zstd").parquet(f"{root}/all_columns")
    projected.write.option("compression", "zstd").parquet(f"{root}/projected")
    files = list_files(spark, root).filter(F.col("path").rlike(r"/part-[^/]*$"))
    sizes = files.groupBy(form_of(F.col("path")).alias("form")).agg(F.sum("length").alias("bytes"))
    raw = sizes.filter(F.col("form") == "raw").select("bytes").scalar()
    return sizes.select("form", "bytes", (raw / F.col("bytes")).alias("ratio"))


def form_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/([^/]+)/part-[^/]*$", 1)
