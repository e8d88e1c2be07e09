"""Toxicity by a learned, weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: case, look-alike letters, digits and signs inside words (``1d10t``) and invisible characters.
The lexicon holds whole words and word beginnings, learned from labelled documents: how much likelier they are in
toxic ones (smoothed log odds) is their weight. Exception phrases are pairs of a lexicon entry and a neighbour
that clean documents use; a match inside one doesn't count. The sum of the matches' weights, and the same per
hundred words, give the score through a logistic curve fitted on the same documents.

Learning uses at most ``SAMPLE`` labelled documents (by least hash of the id); its word statistics are aggregated by Spark, and
at most ``CANDIDATES`` of them reach the driver. Scoring reads whole texts of all documents in one scan without a shuffle.

Null and empty texts score like any text without matches. Without labels of both kinds every score is the
share of toxic labels (0.5 without any). Labels that are null or without a document are not used; of several labels of
an id, the greatest counts; of several documents of a labelled id, the least text is learned from. Null ids can't be labelled and are not held out. Extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hourlake.llm.common import longs
from hourlake.sources.scratch import written

#: Bounds of learning; see above.
SAMPLE = 20_000
CANDIDATES = 50_000
#: Beginnings of words that can be entries, in characters.
STEMS = (4, 5, 6, 7)
ENTRIES = 2_000

# Letters that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "һ": "h", "ԛ": "q", "ѡ": "w", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
}
# Digits and signs that stand for letters inside words.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
# Characters that can't be seen.
INVISIBLE = "­​‌‍⁠﻿"

_LETTERS = str.maketrans({**HOMOGLYPHS, **{chr(0xFF41 + i): chr(97 + i) for i in range(26)}, **dict.fromkeys(INVISIBLE)})
_IN_WORDS = str.maketrans(DIGITS)
_MIXED = re.compile(r"[0134578@$!|]*[^\W\d_][^\W_]*[0134578@$!|][\w@$!|]*[^\W_]|[0134578@$|]+[^\W\d_][^\W_]*")
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[0134578@$|!]")


def _plain(match: re.Match) -> str:
    return match.group().translate(_IN_WORDS)


def fold(text: str) -> list[str]:
    """The text's words without case and disguises."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LETTERS)
    if _SIGNS.search(text):
        text = _MIXED.sub(_plain, text)
    return _WORD.findall(text)


def features(words: Iterable[str]) -> set[str]:
    """Words (in spaces) and word beginnings (with a space before) that can be entries."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if len(w) > n)
    return out


@dataclass(frozen=True)
class Lexicon:
    entries: dict[str, float]
    exceptions: frozenset[str]
    curve: tuple[float, float, float]  # of the sum, of the sum per length, constant

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    """The automaton over a lexicon's entries and exception phrases."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.machine = ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            self.machine.add_word(phrase, (len(phrase), None))
        for entry, weight in lexicon.entries.items():
            self.machine.add_word(entry, (len(entry), weight))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def matches(self, words: list[str]) -> list[tuple[int, str, float]]:
        """Word number, entry and weight of each word that counts: the heaviest entry of a word, outside exceptions."""
        if self.empty or not words:
            return []
        text = " " + " ".join(words) + " "
        found, covered = [], []
        for end, (size, weight) in self.machine.iter(text):
            if weight is None:
                covered.append((end - size + 1, end))
            else:
                found.append((end - size + 1, end, weight))
        # one pass in order of place: how far exceptions reach that began so far, and the number of the word
        found.sort()
        covered.sort()
        out: list[tuple[int, str, float]] = []
        reach, exception, number, counted, last = -1, 0, 0, 0, -1
        for a, b, weight in found:
            while exception < len(covered) and covered[exception][0] <= a:
                reach = max(reach, covered[exception][1])
                exception += 1
            if b <= reach:
                continue
            number += text.count(" ", counted, a)
            counted = a
            if a != last:
                out.append((number, text[a : b + 1], weight))
            elif weight > out[-1][2]:
                out[-1] = (number, text[a : b + 1], weight)
            last = a
        return out

    def sums(self, words: list[str]) -> tuple[float, float]:
        """The weights' sum, and the same for every hundred words."""
        total = sum(w for _, _, w in self.matches(words))
        return total, 100 * total / (len(words) + 20)

    def score(self, words: list[str]) -> float:
        a, b, c = self.lexicon.curve
        total, dense = self.sums(words)
        return float(1 / (1 + np.exp(-np.clip(a * np.log1p(total) + b * np.log1p(dense) + c, -30, 30))))


# ---------------------------------------------------------------- learning


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _pairs(batches_of: int):
    """Sums of ``(feature, label)`` over a batch, so that frequent features cross the network once for a batch."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(texts), batches_of):
                seen = (Counter(), Counter())
                for text, label in zip(texts[i : i + batches_of], labels[i : i + batches_of], strict=True):
                    seen[1 - label].update(features(fold(text or "")))
                names = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), longs([seen[0][x] for x in names]), longs([seen[1][x] for x in names])], schema=schema)

    return rows


def _known_only(wanted: frozenset[str]):
    count = _pairs(2000)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in count(batches):
            yield batch.filter(pa.array([x in wanted for x in batch.column(0).to_pylist()], pa.bool_()))

    return rows


def choose_entries(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: int = 5) -> dict[str, float]:
    """Entries with their weights: features that are much likelier in toxic documents, the shortest that say it."""
    scored = []
    for feature, t, c in counts:
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        if t >= least and odds > 2.5 and t > 2 * c:
            scored.append((feature, float(odds), t))
    scored.sort(key=lambda x: (len(x[0]), x[0]))
    out: dict[str, tuple[float, int]] = {}
    for feature, odds, t in scored:
        # a beginning stands for the longer ones it explains; it must not be worse than they are
        shorter = [feature[: n + 1] for n in range(min(STEMS), len(feature.rstrip())) if feature[: n + 1] in out]
        if not shorter or odds > max(out[s][0] for s in shorter) + 0.7:
            out[feature] = (odds, t)
    best = sorted(out.items(), key=lambda x: (-x[1][0] * np.log1p(x[1][1]), x[0]))[:ENTRIES]
    return {f: min(odds, 6.0) for f, (odds, _) in best}


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on two columns by Newton steps, slightly regularised; slopes aren't negative."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.array([0.05, 0.05, 0.0])
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (max(float(w[0]), 0.0), max(float(w[1]), 0.0), float(w[2]))


def _neighbours(lexicon: Lexicon):
    """Pairs of an entry's word and the word before or after it, by label; and each document's sums."""
    schema = pa.schema([("phrase", pa.string()), ("label", pa.int64()), ("total", pa.float64()), ("dense", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            out = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = fold(text or "")
                out.append((None, label, *matcher.sums(words)))
                phrases = set()
                for at, _, _ in matcher.matches(words):
                    at -= 1  # a match begins with the space before its word
                    at = max(at, 0)
                    for a in (at - 1, at):
                        if 0 <= a and a + 1 < len(words):
                            phrases.add(f" {words[a]} {words[a + 1]} ")
                out.extend((p, label, 0.0, 0.0) for p in phrases)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return rows


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from the labelled documents for which ``training`` (over ``doc_id``) is true."""
    marks = labels.where("toxic is not null and doc_id is not null").where(training)
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("long")).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(marks, "doc_id")
    rows = written(known.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label"), "labelled")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    base = float(np.log((toxic + 0.5) / (clean + 0.5)))
    if not toxic or not clean:
        return Lexicon({}, frozenset(), (0.0, 0.0, base))
    ddl = "feature string, toxic long, clean long"
    often = rows.where("label = 1").mapInArrow(_pairs(2000), ddl).groupBy("feature").agg(F.sum("toxic").alias("toxic"))
    often = often.where(F.col("toxic") >= 5).orderBy(F.desc("toxic"), "feature").limit(CANDIDATES)
    wanted = frozenset(r["feature"] for r in often.collect())
    counts = rows.mapInArrow(_known_only(wanted), ddl).groupBy("feature").agg(F.sum("toxic"), F.sum("clean")).collect()
    lexicon = Lexicon(choose_entries([tuple(r) for r in counts], toxic, clean), frozenset(), (0.0, 0.0, base))
    phrases = _phrases(rows, lexicon).groupBy("phrase").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    spared = phrases.where("phrase is not null and n - toxic >= 3 and 10 * toxic <= n").orderBy(F.desc("n"), "phrase").limit(ENTRIES).collect()
    lexicon = Lexicon(lexicon.entries, frozenset(r["phrase"] for r in spared), lexicon.curve)
    points = _phrases(rows, lexicon).where("phrase is null").select("label", "total", "dense").collect()  # ``sample`` rows at most
    x = np.log1p(np.array([[r["total"], r["dense"]] for r in points]))
    return Lexicon(lexicon.entries, lexicon.exceptions, fit_curve(x, np.array([r["label"] for r in points], dtype=float)))


def _phrases(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    return rows.mapInArrow(_neighbours(lexicon), "phrase string, label long, total double, dense double")


# ---------------------------------------------------------------- scoring


def _scored(lexicon: Lexicon, threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            scores = np.array([matcher.score(fold(t or "")) for t in batch.column("text").to_pylist()], dtype=np.float64)
            cols = {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(scores)}
            yield pa.RecordBatch.from_pydict(cols | {"predicted": pa.array((scores >= threshold).astype(np.int32), pa.int32())})

    return rows


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; held out: crc32 of the id's text modulo 4 is 2."""
    lexicon = learn(docs, labels, remainder(F.col("doc_id")) != 2, sample)
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scored(lexicon, threshold), "doc_id long, held_out boolean, score double, predicted int")
