"""Quality rules as a ledger: measure once, store failure bits, decide later.

``measure`` scans each text once and gives measurements. ``ledger`` evaluates every rule on them and
keeps one failure bit per rule beside the measurements. ``apply_policy`` decides with a versioned policy, which is
only a bit mask, and ``ablation`` tells from the stored bits what each rule alone adds: no text is read again.

Null and empty texts measure as zero everywhere (and fail ``few_words``). Repeated rows and null ids are rows
like others. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hourlake.llm.common import keyed, larger, longs, record, text_bytes
from hourlake.llm.rolling import byte_values, grams, pieces, prefix, ranges, word_hashes, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_digits")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_LETTER = np.zeros(256, dtype=bool)  # ASCII letters and the first bytes of all other characters
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(0xC0, 0x100))] = True
_INNER = np.zeros(256, dtype=bool)  # not the first byte of a character
_INNER[0x80:0xC0] = True


@dataclass(frozen=True)
class Rule:
    """Fails where the condition, an expression over the measurements, is true."""

    name: str
    fails: str


#: A rule's place is its bit, so rules are only ever added at the end. Expressions stay in whole numbers.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines > 3 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("few_letters", "100 * n_letters < 50 * word_chars"),
    Rule("digits", "100 * n_digits > 30 * word_chars"),
)
BIT = {r.name: i for i, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {
    p.version: p
    for p in (BASE, Policy("v1", BASE.rules + ("symbols", "repeated_lines", "short_words", "long_words", "few_letters", "digits")))
}


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: does its document have it twice or more; is it not the first there."""
    several = np.zeros(len(hashes), dtype=bool)
    later = np.zeros(len(hashes), dtype=bool)
    if len(hashes) < 2:
        return several, later
    order = np.lexsort((hashes, doc))  # stable, so the first of equals comes first
    same = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    later[order[1:]] = same
    several[order[1:]] = same
    several[order[:-1]] |= same
    return several, later


def _measure(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    n_docs = len(off) - 1
    start, end, bounds = words(data, off)
    n_words = np.diff(bounds)
    pre = prefix(byte_values(data))
    # words in three-word windows that the text has more than once
    hashes = word_hashes(data, start, end)
    covered = np.zeros(len(hashes), dtype=bool)
    trigrams = grams(prefix(hashes), 3)
    if len(trigrams):
        doc = np.repeat(np.arange(n_docs), n_words)
        inside = np.flatnonzero(doc[: len(trigrams)] == doc[2:])
        several, _ = _repeats(trigrams[inside], doc[inside])
        hit = inside[several]
        for k in range(3):
            covered[hit + k] = True
    # lines: cut at every newline and at the documents' ends
    newline = data == 10
    ends = np.flatnonzero(newline)
    first = np.sort(np.concatenate([off[:-1], ends + 1]))  # empty lines at a document's end keep their place by the sort
    line_doc = np.searchsorted(off, first, side="right") - 1
    line_doc = np.minimum(line_doc, n_docs - 1) if n_docs else line_doc
    last = np.append(first[1:], len(data)) if len(first) else first
    stops = np.minimum(last, off[line_doc + 1]) if len(first) else last
    stops = stops - ((stops > first) & newline[np.maximum(stops - 1, 0)] if len(data) else 0)
    has_word = np.searchsorted(start, stops) > np.searchsorted(start, first)
    at = np.flatnonzero(has_word)
    _, later = _repeats(ranges(pre, first[at], stops[at]), line_doc[at])
    n_lines = _per_doc(newline, off) + 1
    n_dup = np.bincount(line_doc[at][later], minlength=n_docs)[:n_docs] if n_docs else np.zeros(0, np.int64)
    in_words = np.diff(off) - _per_doc(_INNER[data], off) - _per_doc((data == 32) | ((data >= 9) & (data <= 13)), off)
    return [n_words, in_words, _per_doc(_SYMBOL[data], off), n_dup, _per_doc(covered, bounds), n_lines, _per_doc(_LETTER[data], off), _per_doc(_DIGIT[data], off)]


_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(m, pa.int64()) for m in MEASURES]])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = text_bytes(batch)
        for i, j in pieces(off):
            got = _measure(data[off[i] : off[j]], off[i : j + 1] - off[i])
            cols = [batch.column("doc_id").slice(i, j - i), *[longs(x) for x in got]]
            if "_rest" in batch.schema.names:
                cols += [batch.column("text").slice(i, j - i), batch.column("_rest").slice(i, j - i)]
                yield pa.RecordBatch.from_arrays(cols, names=[*_SCHEMA.names, "text", "_rest"])
            else:
                yield record(_SCHEMA, *cols)


def measure(docs: DataFrame, rest: bool = False) -> DataFrame:
    """``doc_id`` and the measurements of every text, in one scan without a shuffle."""
    base = keyed(docs, rest)
    ddl = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    if "_rest" in base.columns:
        ddl += f", text binary, _rest {base.schema['_rest'].dataType.simpleString()}"
        base = base.select("doc_id", "text", "_rest")
    else:
        base = base.select("doc_id", "text")
    return base.mapInArrow(lambda batches: larger(_measured(batches), 2048), ddl)


def failure_bits() -> Column:
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def ledger(docs: DataFrame, rest: bool = False) -> DataFrame:
    """Measurements and ``failed``: bit ``BIT[rule]`` is set where the rule fails. All rules, whatever the policy."""
    return measure(docs, rest).withColumn("failed", failure_bits())


def apply_policy(entries: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    """Adds ``base_failed`` and ``kept``; a policy always contains the base rules."""
    hit = lambda mask: F.col("failed").bitwiseAND(F.lit(mask)) != 0
    return entries.withColumn("base_failed", hit(BASE.mask)).withColumn("kept", ~hit(policy.mask | BASE.mask))


def ablation(entries: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects (kept if it were dropped).

    The stored bits are first counted by value: at most ``2 ** len(RULES)`` rows, whatever the corpus.
    """
    bits = F.col("failed").bitwiseAND(F.lit(policy.mask))
    counted = entries.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << BIT[n]).cast("long").alias("bit")) for n in policy.rules]))
    each = counted.select("bits", "docs", rules.alias("r")).select("docs", "bits", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("docs")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs")).otherwise(0)).alias("only_this"),
        F.lit(policy.version).alias("policy"),
    )


def passing_documents(docs: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, unchanged."""
    entries = apply_policy(ledger(docs, rest=True), policy).filter("kept")
    out = [F.col("doc_id") if c == "doc_id" else F.col("text").cast("string").alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns]
    return entries.select(*out)
