"""Which keys a table may hold: Bloom bitmaps over hashed keys, built and asked by built-in functions only.

A bitmap says "surely not" or "maybe" about a key. It is a table of 64-bit words; a key has one word, in which it sets
``MARKS`` bits, so a question is one equi join on the word's number. With ``BITS_PER_KEY`` bits for each key a
few in ten thousand other keys pass by chance, which costs work and never a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Room for each key, and bits that a key sets.
BITS_PER_KEY = 32
MARKS = 5
#: Words of the largest bitmap that is broadcast (32 MB); it fills up beyond some 4 million keys and lets more pass.
MOST_WORDS = 1 << 21


def words_for(keys: int, most: int | None = MOST_WORDS) -> int:
    """Words for so many keys, a power of two."""
    need = 1 << (max(1, -(-keys * BITS_PER_KEY // 64)) - 1).bit_length()
    return need if most is None else min(most, need)


def word_of(keys: Sequence[str], words: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), words.cast("long"))


def marks_of(keys: Sequence[str]) -> Column:
    """The bits that a key sets in its word; null keys count as keys."""
    spread = F.xxhash64(F.lit(1), *keys)
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    return reduce(lambda a, b: a.bitwiseOR(b), [one(i) for i in range(MARKS)])


def bitmap(df: DataFrame, keys: Sequence[str], words: Column, by: Sequence[str] = ()) -> DataFrame:
    """``by…, words, word, bits``: the words of the rows' keys, apart for each value of ``by`` (on which ``words`` may depend)."""
    at = df.select(*by, words.cast("long").alias("words"), word_of(keys, words).alias("word"), marks_of(keys).alias("bits"))
    return at.groupBy(*by, "words", "word").agg(F.bit_or("bits").alias("bits"))


def maybe_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys ``known`` may hold; those that it holds are never lost.

    ``known`` is read twice, so it should be a written table. The bitmap's size is bounded, therefore it is broadcast.
    """
    words = F.lit(words_for(known.count()))
    held = bitmap(known, keys, words).select("word", "bits")
    marks = marks_of(keys)
    return df.join(F.broadcast(held), (word_of(keys, words) == F.col("word")) & (F.col("bits").bitwiseAND(marks) == marks), "left_semi")


def holders(index: DataFrame, sizes: Sequence[int], asked: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Distinct values of ``by`` whose bitmap in ``index`` may hold one of the keys in ``asked``.

    ``sizes``: the values of ``words`` that occur in the index (powers of two, so there are few).
    """
    each = asked.select(*keys, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("_words"))
    each = each.select(F.col("_words").alias("words"), word_of(keys, F.col("_words")).alias("word"), marks_of(keys).alias("_marks")).distinct()
    return index.join(each, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("_marks")) == F.col("_marks")).select(by).distinct()
