"""N-gram Jaccard self-join of documents with a token-group matrix.

A document is the set of its distinct shingles (tokens); two documents link if the Jaccard similarity of their sets reaches
the threshold. Equal sets are one *class*, so copies never meet in pairs. With threshold J, sets of n tokens only link if
they share at least ``needed(n) = ceil(J n)`` of them.

1. *The whole corpus as one group.* A class can't link if fewer than ``needed(n)`` of its tokens occur elsewhere. This is tested
   twice by counting tokens: first on a part of the tokens (those with the least hashes, of which a link must share a
   certain number), which rejects most documents; then on all tokens of the classes that are left.
2. *Groups.* Classes with one min-hash are dealt to groups of about ``GROUP`` classes and ``TOKENS`` tokens. In a
   group all overlaps are found by one sparse-dense product per slice of tokens. This is done for two min-hashes, and
   the components so far are known: what is already connected need not be compared again.
3. *The matrix.* Groups are formed anew, of one large component each or of all other classes by a min-hash. The matrix has a row
   (token, group) for every token in the union of the members' rarest tokens (a link must share one of a class's
   ``n - needed(n) + 1`` rarest). A class is a query: its rarest tokens find the groups that could hold a partner, by size,
   by the number of tokens that either side shares with anyone, and by component; where it goes, its overlap with the group's whole union bounds that with each member, and only
   groups where the bound suffices are opened. Their members are compared exactly, through the union's postings.

Every link between different components is found, links inside a component may be skipped; so components are exact.
Frequent tokens are the last in the order of rarity, hence hardly ever probed. Queries of a group that very many ask are dealt to copies
of the (bounded) group; texts are shuffled once, and only those of classes that pass the first test in step 1 (a bitmap of bounded size
holds back nearly all others). Tokens are 64-bit hashes.

Defined results: null, empty and blank texts have an empty set, are linked with nothing and form a component of their own, named by
their id. Rows with equal ids are separate documents. A row with a null id links like any other, but never names
a component unless no member has an id. An empty table gives no row. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from hourlake.llm.common import keyed, longs, record, signed, text_bytes, unsigned
from hourlake.llm.components import components
from hourlake.llm.repeats import texts_of
from hourlake.llm.rolling import grams, pieces, prefix, word_hashes, words
from hourlake.operators.membership import maybe_known
from hourlake.sources.scratch import written

#: Classes and tokens of a group that one task compares with each other.
GROUP = 1024
TOKENS = 1 << 18
#: Queries that one copy of a group answers.
QUERIES = 1024
#: Tokens of one dense slice.
SLICE = 1 << 13
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Tokens and classes are cut to so many bits in the first test, where a chance meeting only costs work.
SHORT = (1 << 48) - 1


class Threshold:
    """``numerator / denominator`` as whole numbers, for numbers and columns alike."""

    def __init__(self, numerator: int = 90, denominator: int = 100):
        if not 0 < numerator <= denominator:
            raise ValueError("the threshold lies in (0, 1]")
        self.num, self.den = numerator, denominator

    def needed(self, n):
        """Tokens that a set of n shares at least with a partner; partners have no fewer tokens either."""
        if isinstance(n, Column):
            return F.floor((n * self.num + (self.den - 1)) / self.den).cast("long")
        return (n * self.num + self.den - 1) // self.den

    def spare(self, n):
        """So many more of the least (or rarest) tokens are looked at, and found shared, in the first test."""
        return np.maximum(1, n // 10)

    def enough(self, overlap, n, m):
        """Whether so large an overlap could link sets of n and (at least) m tokens."""
        return (self.num + self.den) * overlap >= self.num * (n + m)

    def links(self, overlap, n, m):
        return self.den * overlap >= self.num * (n + m - overlap)


# ---------------------------------------------------------------- tokens


def token_sets(data: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its distinct tokens, ascending."""
    out: list[np.ndarray] = []
    for i, j in pieces(off):
        start, stop, first = words(low := _LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i])
        pre = prefix(word_hashes(low, start, stop))
        runs = {n: grams(pre, n) for n in range(1, size + 1)}
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            n = min(size, b - a)
            out.append(np.unique(runs[n][a : b - n + 1]) if n else np.zeros(0, np.uint64))
    return out


def _nested(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = np.concatenate([*lists, np.zeros(0, np.uint64)])
    return pa.ListArray.from_arrays(pa.array(ends), signed(flat))


_SETS = pa.schema([("doc_id", pa.int64()), ("_row", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("least", pa.list_(pa.int64()))])
_SETS_DDL = "doc_id long, _row long, cls long, n long, least array<long>"


def _sets(size: int, limit: Threshold):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = token_sets(*text_bytes(batch), size)
            n = np.array([len(t) for t in found], dtype=np.int64)
            part = n - limit.needed(n) + limit.spare(n)
            cls = np.array([xxhash.xxh3_64_intdigest(t.tobytes()) for t in found], dtype=np.uint64)
            yield record(_SETS, batch.column(0), batch.column(1), signed(cls), longs(n), _nested([t[:p] for t, p in zip(found, part.tolist(), strict=True)]))

    return rows


def _all_tokens(size: int):
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("token", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, raw = batch.column("cls").to_numpy(), texts_of(batch)
            for i in range(0, len(raw), 64):
                part = raw[i : i + 64]
                off = np.cumsum([0, *map(len, part)])
                found = token_sets(np.frombuffer(b"".join(part), np.uint8), off, size)
                n = np.array([len(t) for t in found], dtype=np.int64)
                yield record(schema, longs(np.repeat(cls[i : i + 64], n)), longs(np.repeat(n, n)), signed(np.concatenate([*found, np.zeros(0, np.uint64)])))

    return rows


# ---------------------------------------------------------------- step 1: what could link at all


def likely(sets: DataFrame, limit: Threshold) -> DataFrame:
    """``cls``: classes whose least tokens occur elsewhere often enough (copies of a class count as elsewhere here)."""
    each = sets.where("n > 0").select(F.col("cls").bitwiseAND(F.lit(SHORT)).alias("c"), F.explode("least").alias("t")).select("c", F.col("t").bitwiseAND(F.lit(SHORT)).alias("t"))
    known = each.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("t")
    shared = each.join(known, "t").groupBy("c").agg(F.count(F.lit(1)).alias("shared"))
    classes = sets.where("n > 0").groupBy("cls").agg(F.max("n").alias("n"))
    enough = F.greatest(F.lit(1), F.floor(limit.needed(F.col("n")) / 10))
    return classes.join(shared, F.col("cls").bitwiseAND(F.lit(SHORT)) == F.col("c")).where(F.col("shared") >= enough).select("cls", "n")


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield batch.set_column(1, "text", pa.array([pack(t or b"") for t in batch.column(1).to_pylist()], pa.binary()))


def able(docs: DataFrame, sets: DataFrame, size: int, limit: Threshold) -> DataFrame:
    """``cls, n, tokens, probe, m1, m2``: classes that could link, with the tokens they share with others, rarest first.

    ``probe``: of how many of these a partner must have one; ``m1, m2``: two min-hashes.
    """
    some = written(likely(sets, limit), "likely")
    one = written(sets.select("cls", "_row").join(some.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.min("_row").alias("_row")), "representatives")
    texts = maybe_known(keyed(docs).select("_row", "text"), one, ["_row"]).mapInArrow(_compressed, "_row long, text binary")
    texts = texts.groupBy("_row").agg(F.any_value("text").alias("text"))  # of repeated rows one
    texts = written(texts.join(one, "_row").select("cls", "text"), "texts")
    each = texts.mapInArrow(_all_tokens(size), "cls long, n long, token long")
    known = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = each.join(known, "token").groupBy("cls").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    tokens = F.col("t.token")
    found = shared.where(F.size("t") >= limit.needed(F.col("n"))).select("cls", "n", tokens.alias("tokens"))
    mixed = F.array_min(F.transform("tokens", lambda t: F.xxhash64(t)))
    probe = F.size("tokens") - limit.needed(F.col("n")) + 1
    return written(found.select("cls", "n", "tokens", probe.cast("int").alias("probe"), F.array_min("tokens").alias("m1"), mixed.alias("m2")), "able")


# ---------------------------------------------------------------- step 2: groups that are compared whole


def overlaps(tokens: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from slices of the token matrix (tokens of one set only are left out)."""
    flat = np.concatenate(tokens)
    doc = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    _, at, often = np.unique(flat, return_inverse=True, return_counts=True)
    keep = often[at] > 1
    place = np.cumsum(often > 1) - 1
    doc, at = doc[keep], place[at[keep]]
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    total = np.zeros((len(tokens), len(tokens)), dtype=np.int64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, SLICE):
        i, j = np.searchsorted(at, [low, low + SLICE])
        part = np.zeros((len(tokens), SLICE), dtype=np.float32)
        part[doc[i:j], at[i:j] - low] = 1
        total += (part @ part.T).astype(np.int64)
    return total


def _roots(n: int, pairs: Iterator[tuple[int, int]]) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]], off - off[0]


def _inside(limit: Threshold):
    """Rows ``g, cls, n, tokens``, sorted by group: links that connect what is connected inside a group (never more than ``GROUP``)."""

    def connected(group: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
        cls, n = [g[0] for g in group], np.array([g[1] for g in group])
        near = limit.links(overlaps([g[2] for g in group]), n[:, None], n[None, :])
        a, b = np.nonzero(np.triu(near, 1))
        return [(cls[i], cls[r]) for i, r in enumerate(_roots(len(group), zip(a.tolist(), b.tolist(), strict=True))) if r != i]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key, held, out = [], None, 0, []
        for batch in batches:
            keys, cls, n = (batch.column(i).to_pylist() for i in range(3))
            flat, off = _lists(batch.column(3))
            for i, k in enumerate(keys):
                mine = flat[off[i] : off[i + 1]]
                if group and (k != key or len(group) >= GROUP or held + len(mine) > TOKENS):
                    if len(group) > 1:
                        out += connected(group)
                    group, held = [], 0
                key, held = k, held + len(mine)
                group.append((cls[i], n[i], mine))
            if len(out) >= 1 << 13:
                yield record(_LINK, *zip(*out, strict=True))
                out = []
        if len(group) > 1:
            out += connected(group)
        if out:
            yield record(_LINK, *zip(*out, strict=True))

    return rows


def dealt(rows: DataFrame, key: Column) -> DataFrame:
    """``rows`` (with ``cls, tokens``) with ``g``: classes with one key, in as many groups as their number and tokens need."""
    rows = rows.withColumn("_key", key)
    size = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.size("tokens")).alias("_t"))
    pieces = F.greatest(F.ceil(F.col("_n") / GROUP), F.ceil(F.col("_t") / TOKENS))
    piece = F.pmod(F.xxhash64("cls"), F.col("_pieces"))
    sized = rows.join(size.select("_key", pieces.alias("_pieces")), "_key")
    return sized.withColumn("g", F.xxhash64("_key", piece)).drop("_key", "_pieces")


def links_inside(sets: DataFrame, key: str, limit: Threshold) -> DataFrame:
    groups = dealt(sets.select(key, "cls", "n", "tokens"), F.col(key)).select("g", "cls", "n", "tokens")
    return groups.repartition("g").sortWithinPartitions("g").mapInArrow(_inside(limit), "a long, b long")


# ---------------------------------------------------------------- step 3: the token-group matrix


def matrix_groups(sets: DataFrame) -> DataFrame:
    """``cls, g``: groups of one large component each, and of all other classes, where those with one min-hash stay together."""
    buckets = max(1, -(-sets.count() // GROUP))
    large = F.col("members") >= GROUP // 4
    key = F.struct(large.alias("large"), F.when(large, F.col("comp")).otherwise(F.pmod(F.xxhash64("m1"), F.lit(buckets))).alias("of"))
    return dealt(sets.select("cls", "tokens", "comp", "members", "m1"), key).select("cls", "g")


def questions(sets: DataFrame, groups: DataFrame, limit: Threshold) -> DataFrame:
    """``q, g``: the groups that may hold a partner of a class in another component.

    Of two components the one that is less (by members, then name) asks.
    """
    rank = F.struct("members", "comp")
    probes = sets.select("cls", "n", "comp", "members", F.size("tokens").cast("long").alias("shared"), F.explode(F.slice("tokens", F.lit(1), F.col("probe"))).alias("token"))
    top = probes.groupBy("token").agg(F.max(rank).alias("top"), F.min(rank).alias("bottom")).where("bottom < top").drop("bottom")
    asking = probes.join(top, "token").where(rank < F.col("top"))
    asking = asking.select(F.col("cls").alias("q"), F.col("n").alias("q_n"), F.col("shared").alias("q_shared"), rank.alias("by"), "token")
    rows = probes.join(groups, "cls").groupBy("token", "g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("shared").alias("most"), F.max(rank).alias("of"))
    fits = (F.col("hi") >= limit.needed(F.col("q_n"))) & (limit.needed(F.col("lo")) <= F.col("q_n"))
    # the smallest partner that sizes allow, and the most that either side shares with anyone
    least = F.greatest(F.col("lo"), limit.needed(F.col("q_n")))
    fits = fits & limit.enough(F.least("q_shared", "most"), F.col("q_n"), least)
    return asking.join(rows, "token").where((F.col("by") < F.col("of")) & fits).select("q", "g").distinct()


class Union:
    """The tokens of a group's members with their postings."""

    def __init__(self, members: list[tuple[int, int, int, np.ndarray]]):
        self.cls, self.comp, self.n = (np.array([m[i] for m in members], dtype=np.int64) for i in range(3))
        flat = np.concatenate([m[3] for m in members])
        order = np.argsort(flat, kind="stable")
        self.who = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])[order]
        self.tokens, self.start, self.often = np.unique(flat[order], return_index=True, return_counts=True)

    def partners(self, cls: int, comp: int, n: int, tokens: np.ndarray, limit: Threshold) -> np.ndarray:
        """Members of other components that the query links with; the group is only opened if the bound allows one."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        if not limit.enough(len(at), n, max(limit.needed(n), int(self.n.min()))):
            return self.cls[:0]
        often = self.often[at]
        posting = np.arange(often.sum()) + np.repeat(self.start[at] - (np.cumsum(often) - often), often)
        overlap = np.bincount(self.who[posting], minlength=len(self.cls))
        return np.flatnonzero(limit.links(overlap, n, self.n) & (self.comp != comp))


def _opened(limit: Threshold):
    """Rows ``g, copy, asks, cls, comp, n, tokens``, sorted, members first: a link for each component that a query reaches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, union, out = None, [], None, []
        for batch in batches:
            g, copy, asks, cls, comp, n = (batch.column(i).to_pylist() for i in range(6))
            flat, off = _lists(batch.column(6))
            for i in range(len(g)):
                if (g[i], copy[i]) != key:
                    key, members, union = (g[i], copy[i]), [], None
                mine = flat[off[i] : off[i + 1]]
                if not asks[i]:
                    members.append((cls[i], comp[i], n[i], mine))
                    continue
                union = union or Union(members)
                hits = union.partners(cls[i], comp[i], n[i], mine, limit)
                out += {int(union.comp[h]): (cls[i], int(union.cls[h])) for h in hits}.values()
            if len(out) >= 1 << 13:
                yield record(_LINK, *zip(*out, strict=True))
                out = []
        if out:
            yield record(_LINK, *zip(*out, strict=True))

    return rows


def links_between(sets: DataFrame, limit: Threshold) -> DataFrame:
    """Links between components; ``sets`` has ``comp`` and ``members`` (its size) too."""
    groups = written(matrix_groups(sets), "groups")
    asked = written(questions(sets, groups, limit), "questions")
    copies = asked.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("copies"))
    body = sets.select("cls", "comp", "n", "tokens")
    members = groups.join(copies, "g").select("cls", "g", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")).join(body, "cls")
    asking = asked.join(copies, "g").select(F.col("q").alias("cls"), "g", F.pmod(F.xxhash64("q"), F.col("copies")).cast("int").alias("copy")).join(body, "cls")
    columns = ("g", "copy", "asks", "cls", "comp", "n", "tokens")
    both = members.withColumn("asks", F.lit(False)).select(*columns).unionByName(asking.withColumn("asks", F.lit(True)).select(*columns))
    return both.repartition("g", "copy").sortWithinPartitions("g", "copy", "asks").mapInArrow(_opened(limit), "a long, b long")


# ---------------------------------------------------------------- the operator


def linked_classes(docs: DataFrame, sets: DataFrame, size: int, limit: Threshold) -> DataFrame:
    """``node, component`` of all classes that are linked with another one."""
    sets = able(docs, sets, size, limit)
    inside = written(links_inside(sets, "m1", limit).unionByName(links_inside(sets, "m2", limit)), "inside")
    found = written(components(inside), "so-far")
    known = found.join(found.groupBy("component").agg(F.count(F.lit(1)).alias("members")), "component").withColumnRenamed("component", "comp")
    sets = sets.join(known.withColumnRenamed("node", "cls"), "cls", "left")
    sets = written(sets.withColumns({"comp": F.coalesce("comp", "cls"), "members": F.coalesce("members", F.lit(1).cast("long"))}), "matrix")
    return components(inside.unionByName(written(links_between(sets, limit), "between")))


def jaccard_components(docs: DataFrame, size: int = 3, numerator: int = 90, denominator: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; links reach ``numerator / denominator``."""
    limit = Threshold(numerator, denominator)
    sets = written(keyed(docs).select("doc_id", "_row", "text").mapInArrow(_sets(size, limit), _SETS_DDL), "sets")
    linked = written(linked_classes(docs, sets, size, limit), "components").withColumnRenamed("node", "cls")
    classes = sets.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least")).join(linked, "cls", "left").withColumn("root", F.coalesce("component", "cls"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.select("cls", "root").join(named, "root").select("cls", "component_id")
    out = sets.select("doc_id", "cls", "n").join(named, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
