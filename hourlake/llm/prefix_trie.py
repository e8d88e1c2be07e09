"""Prefix trie of conversations by fixed-length block hashing.

Conversations are cut into blocks of ``block`` turns. A conversation's first turns are identified by a 128-bit digest that is the
exclusive or of one hash for each (place, turn), so that the digest before and after every block comes from cumulated
blocks, in any order and in pieces.

1. Conversations are grouped by (block number, digest before, digest of the block): one aggregate, in which any number of
   copies become one row, map-side.
2. A block that has no sibling (no other block after the same digest) gives its nodes directly: all its turns have
   the members of the block. Only where siblings diverge are turn boundaries looked at: the turns of each *different*
   block are hashed and grouped, weighted with the block's members.
3. Every node belongs to its smallest member. So what lies below a node is the sum, over its members, of what these own
   there: again sums by block first, refined where siblings diverge. No level-by-level rounds, whatever the depth.

Texts stay where they are: turns are reduced to a digest and a length in the scan. Turns are numbered by dealing them out in
order (conversation, turn), numbering each slice, and adding the counts of earlier slices, so a conversation with a third
of all turns is spread over many tasks. The same is done with running digests and sums. A node with very many children is only
the key of aggregates and of joins that adaptive execution can split. Member lists are joined in bounded pieces
before the pieces of a node are hashed as a stream.

Defined results: rows without ``conv_id`` belong to no conversation and are left out; a null role or text is empty; a null
turn comes first; rows of one turn are ordered by role and then by a digest of role and text; repeated rows are separate turns.
An empty table has no node. ``c - c % 100`` follows the sign of c. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hourlake.llm.common import longs, record
from hourlake.sources.scratch import written

#: Turns of a block.
BLOCK = 4
#: Blocks (or nodes) of one conversation that a single task cumulates.
CHUNK = 1 << 14
#: Bytes of one piece of a member list.
PIECE = 1 << 16
#: Conversations that share their first turns, and how many turns at most.
FAMILY, SHARED = 100, 6
KEY = ("k1", "k2")


# ---------------------------------------------------------------- turns


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, chars``: turns numbered from 1 in each conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.length(text).cast("long").alias("chars")
    )
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    slices = max(1, int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = written(turns, "turns").repartitionByRange(slices, "conv_id", *order).withColumn("slice", F.spark_partition_id())
    dealt = written(dealt, "dealt")
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))  # a conversation is in few slices
    start = counts.select("conv_id", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy(*order))
    return dealt.join(start, ["conv_id", "slice"]).select("conv_id", (F.col("start") + own).alias("pos"), "digest", "chars")


def shared_turns(c: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(c.cast("string").cast("binary")) % SHARED).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv_id`` and their rebuilt turns ``conv_id, pos, z1, z2, chars``.

    The first h turns of conversation ``c - c % 100`` and then c's own after its first h, h = crc32(c) % 6.
    """
    c = F.col("conv_id")
    convs = turns.select("conv_id").distinct().withColumn("h", shared_turns(c)).withColumn("first", c - c % FAMILY)
    heads = turns.where((c % FAMILY == 0) & (F.col("pos") < SHARED)).select(c.alias("first"), "pos", "digest", "chars")
    borrowed = convs.where("h > 0").join(heads, "first").where("pos <= h").select("conv_id", "pos", "digest", "chars")
    have = borrowed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("have"))
    shift = convs.join(have, "conv_id", "left").select("conv_id", "h", (F.coalesce("have", F.lit(0)) - F.col("h")).alias("shift"))
    own = turns.join(shift, "conv_id").where("pos > h").select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "chars")
    hashed = (F.xxhash64("pos", "digest").alias("z1"), F.xxhash64("digest", "pos").alias("z2"))
    return convs.select("conv_id"), own.unionByName(borrowed).select("conv_id", "pos", *hashed, "chars")


# ---------------------------------------------------------------- running values of a conversation, in chunks


def running(df: DataFrame, order: str, values: dict[str, tuple[str, str]], width: int) -> DataFrame:
    """``df`` with, for each ``name: (column, "xor" or "sum")``, that column cumulated over all earlier rows of the conversation.

    Rows are cut into chunks by ``order`` (a number that grows by 1); earlier chunks are carried as one row each.
    """
    fold = {"xor": F.bit_xor, "sum": F.sum}
    df = df.withColumn("_chunk", F.floor(F.col(order) / width))
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    each = df.groupBy("conv_id", "_chunk").agg(*[fold[f](c).alias(f"_{n}") for n, (c, f) in values.items()])
    before = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = each.select("conv_id", "_chunk", *[zero(fold[f](f"_{n}").over(before)).alias(f"_{n}") for n, (_, f) in values.items()])
    inside = Window.partitionBy("conv_id", "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(carry, ["conv_id", "_chunk"])
    both = lambda n, c, f: _plus(f, F.col(f"_{n}"), zero(fold[f](c).over(inside)))
    return joined.select(*[c for c in df.columns if c != "_chunk"], *[both(n, c, f).alias(n) for n, (c, f) in values.items()])


def _plus(kind: str, a: Column, b: Column) -> Column:
    return a + b if kind == "sum" else a.bitwiseXOR(b)


# ---------------------------------------------------------------- blocks and nodes


def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """``conv_id, block, p1, p2, x1, x2, turns``: blocks, their digests, and the digests of all that comes before."""
    of = F.floor((F.col("pos") - 1) / size).alias("block")
    found = turns.groupBy("conv_id", of).agg(
        F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"), F.array_sort(F.collect_list(F.struct("pos", "z1", "z2", "chars"))).alias("turns")
    )
    return running(found, "block", {"p1": ("x1", "xor"), "p2": ("x2", "xor")}, CHUNK)


def _boundaries(size: int) -> Column:
    """The nodes of a block: for each turn its depth, its own key, its parent's key and its length."""

    def turn(i: int) -> Column:
        return F.get("turns", F.lit(i))

    def after(n: int, lane: str) -> Column:
        return reduce(lambda a, i: a.bitwiseXOR(turn(i)[f"z{lane}"]), range(n), F.col(f"p{lane}"))

    nodes = [
        F.struct(turn(i)["pos"].alias("depth"), after(i + 1, "1").alias("k1"), after(i + 1, "2").alias("k2"), after(i, "1").alias("q1"), after(i, "2").alias("q2"), turn(i)["chars"].alias("chars"))
        for i in range(size)
    ]
    return F.inline(F.filter(F.array(*[F.when(F.size("turns") > i, n) for i, n in enumerate(nodes)]), lambda x: x.isNotNull()))


def refined(groups: DataFrame, sums: dict[str, Column], size: int = BLOCK) -> DataFrame:
    """Nodes ``depth, k1, k2, q1, q2, chars`` with ``sums`` of the blocks they are in; grouped by turn only where siblings diverge."""
    columns = ("depth", *KEY, "q1", "q2", "chars")
    opened = lambda on: groups.where(on).select(*sums, _boundaries(size)).select(*columns, *sums)
    merged = opened("diverging").groupBy("depth", *KEY).agg(*[F.any_value(c).alias(c) for c in columns[3:]], *[f.alias(n) for n, f in sums.items()])
    return opened("not diverging").unionByName(merged)


def member_lists(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` for nodes at which conversations end."""
    by = ("depth", *KEY)
    key = [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
    piece, digest = pa.schema([*key, ("first", pa.int64()), ("ids", pa.binary())]), pa.schema([*key, ("ends_sha256", pa.string())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, out = None, 0, bytearray(), []
        for batch in batches:
            for *at, c in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                if at != now or len(ids) > PIECE:
                    if now is not None:
                        out.append((*now, first, bytes(ids)))
                    now, first, ids = at, c, bytearray()
                ids += b",%d" % c
            if len(out) >= 256:
                yield record(piece, *zip(*out, strict=True))
                out = []
        if now is not None:
            out.append((*now, first, bytes(ids)))
        if out:
            yield record(piece, *zip(*out, strict=True))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for batch in batches:
            for *at, _, ids in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                if at == now:
                    sha.update(ids)
                    continue
                if now is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha = at, hashlib.sha256(ids[1:])
            if len(out) >= 1 << 14:
                yield record(digest, *zip(*out, strict=True))
                out = []
        if now is not None:
            out.append((*now, sha.hexdigest()))
        if out:
            yield record(digest, *zip(*out, strict=True))

    pieces = ends.select(*by, "conv_id").repartitionByRange(*by, "conv_id").sortWithinPartitions(*by, "conv_id")
    pieces = pieces.mapInArrow(joined, "depth long, k1 long, k2 long, first long, ids binary")
    pieces = pieces.repartition(*by).sortWithinPartitions(*by, "first")
    return pieces.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    convs, turns = rebuilt(written(numbered_turns(conversations), "numbered"))
    convs, cut = written(convs, "conversations"), written(blocks(turns, block), "blocks")
    same, before = ("block", "p1", "p2", "x1", "x2"), ("block", "p1", "p2")

    # blocks that are equal up to their end, and whether others follow the same turns
    groups = cut.groupBy(*same).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns"))
    groups = written(groups, "groups")
    siblings = groups.groupBy(*before).agg((F.count(F.lit(1)) > 1).alias("diverging"))
    groups = written(groups.join(siblings, [*before]), "groups")

    # nodes: members, smallest member, children
    total = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("q1"), none.alias("q2"), zero.alias("chars"), "n_convs", "conv_id")
    nodes = refined(groups, {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")}, block).unionByName(root)
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["depth", *KEY], "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = written(running(nodes, "depth", {"above": ("saved", "sum")}, CHUNK), "nodes")

    # what each conversation owns, summed up over the members of every node
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    owned = written(owned, "owned")
    sums = cut.select("conv_id", *same).join(owned, "conv_id").groupBy(*same).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    below = refined(groups.select(*same, "turns", "diverging").join(sums, [*same]), {"saved": F.sum("saved"), "leaves": F.sum("leaves")}, block)
    whole = owned.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "saved", "leaves")
    below = below.select("depth", *KEY, "saved", "leaves").unionByName(whole)

    # conversations that end at a node
    last = cut.groupBy("conv_id").agg(F.max(F.col("block") * block + F.size("turns")).alias("depth"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("depth", *KEY)])

    out = nodes.drop("saved").join(below, ["depth", *KEY]).join(member_lists(ends), ["depth", *KEY], "left")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    deep = out.where("depth > 1").join(parents, ["depth", "q1", "q2"], "left")
    top = out.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(total["least"]).cast("long")))
    return deep.unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )
