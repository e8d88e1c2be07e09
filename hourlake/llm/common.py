"""What the operators of this package share: row identity, text bytes, shared scratch, UTF-8 counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hourlake.llm.rolling import texts

#: Stands for a null id where ids are compared or joined; nulls are smaller than every id.
NO_ID = -(1 << 63)
ROW = ("_id", "_row")


def keyed(docs: DataFrame, rest: bool = False) -> DataFrame:
    """``_id``, ``_row``, ``doc_id``, ``text`` (binary) and, if asked for, all other columns as ``_rest``.

    ``(_id, _row)`` identifies a row by its id and text, so repeated ids with different texts stay
    apart, and identical rows share whatever is decided about them. Other columns are never looked at, so
    their names can't clash with ours.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cols = [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("doc_id", "text").alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    ]
    if rest and others:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest"))
    return docs.select(*cols)


def with_key(docs: DataFrame) -> DataFrame:
    """``_key`` (``_id, _row`` as a struct) and the whole row as ``_doc``, so that no column name can clash."""
    key = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("doc_id", "text").alias("_row"))
    return docs.select(key.alias("_key"), F.struct("*").alias("_doc"))


def like_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """Back from ``keyed(rest=True)``: the columns of ``docs`` with the new text; ``n_chars`` follows it."""
    out: list[Column] = []
    for c in docs.columns:
        if c == "doc_id":
            out.append(F.col("doc_id"))
        elif c == "text":
            out.append(F.col("text").cast("string").alias("text"))
        elif c == "n_chars":
            out.append(F.length(F.col("text").cast("string")).cast("long").alias("n_chars"))
        else:
            out.append(F.col("_rest").getField(c).alias(c))
    return changed.select(*out)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    return texts(batch.column(batch.schema.get_field_index(name)))


def text_list(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


def signed(values: np.ndarray) -> pa.Array:
    """Hashes as the signed longs that Spark stores."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def larger(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many (but for the last), each of which costs the JVM a call."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
