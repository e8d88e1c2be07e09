"""Bitmaps over keys: nothing that is known is lost, few others pass, and their size is bounded."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourlake.operators import membership


def test_known_keys_pass_and_few_others(spark):
    known = spark.range(0, 3000, 3).withColumn("name", F.concat(F.lit("n"), "id"))
    asked = spark.range(30_000).withColumn("name", F.concat(F.lit("n"), "id"))
    got = {r.id for r in membership.maybe_known(asked, known, ["id", "name"]).collect()}
    assert set(range(0, 3000, 3)) <= got
    assert len(got) < 1000 + 29_000 / 500


def test_full_bitmap_lets_more_pass_but_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(membership, "words_for", lambda keys: 1)
    known = spark.range(5000)
    assert membership.maybe_known(spark.range(6000), known, ["id"]).where("id < 5000").count() == 5000


def test_nothing_known(spark):
    assert membership.maybe_known(spark.range(100), spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize(("keys", "words"), [(0, 1), (1, 1), (2, 1), (5, 4), (1000, 512), (1 << 40, membership.MOST_WORDS)])
def test_sizes(keys, words):
    assert membership.words_for(keys) == words


def test_holders(spark):
    rows = spark.range(2000).withColumn("day", (F.col("id") % 4).cast("int")).withColumn("words", F.when(F.col("day") < 2, 256).otherwise(512))
    index = membership.bitmap(rows, ["id"], F.col("words"), ["day"])
    asked = spark.createDataFrame([(5,), (9,), (10_003,)], "id long")
    assert sorted(r.day for r in membership.holders(index, [256, 512], asked, ["id"], "day").collect()) == [1]
