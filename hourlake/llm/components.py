"""Connected components of a link table by alternating star contractions, in DataFrame operations.

Each round is an aggregate and a join on node ids; labels shrink to the least id of a component. Every round
is written to the shared scratch folder, so lost executors cost one round at most, and nothing
reaches the driver but a row count. A node with very many links is pre-aggregated before the
shuffle and its rows can be split by adaptive execution in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourlake.sources.scratch import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction. Links are ``a > b``. Large: a node's greater neighbours get its least neighbour; small:
    its lesser ones and itself do."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node id of each component) for every node that has a link.

    ``links`` has two long columns ``a, b``; direction, repeats and self-links don't matter. No links give no rows.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, seen = written(now, "links"), None
    while True:
        now = written(_star(_star(now, large=True), large=False), "links")
        # a forest of stars: every node once, and no root is also a leaf
        state = now.agg(F.count(F.lit(1)), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
