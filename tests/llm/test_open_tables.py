"""Tables whose members lie in different components: what is dealt, and that every pair of them meets."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from faremill.llm import neardup


def opened(spark, tables):
    """tables: name -> component of each member; the first member is the hub."""
    rows = [(t, 1000 * t + n, 1000 * t, t % 3, 3, 1000 * t + c) for t, held in tables.items() for n, c in enumerate(held)]
    return spark.createDataFrame(rows, "table long, node long, hub long, i int, j int, component long")


def test_one_stray_among_many_is_dealt_once_for_every_block(spark):
    giant = spark.range(20_000).select(F.lit(7).alias("table"), F.col("id").alias("node"), F.lit(0).alias("hub"), F.lit(0).alias("i"), F.lit(1).alias("j"), F.lit(0).alias("component"))
    stray = spark.range(20_000, 20_001).select(F.lit(7).alias("table"), F.col("id").alias("node"), F.lit(0).alias("hub"), F.lit(0).alias("i"), F.lit(1).alias("j"), F.lit(5).alias("component"))
    dealt = neardup.open_pairs(giant.unionByName(stray))
    blocks = -(-20_000 // neardup.TABLE_BLOCK)
    assert dealt.where("component = 0").count() == 19_999
    assert dealt.where("component = 5").count() == blocks + 1


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_members_of_different_components_meet_in_one_block(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "TABLE_BLOCK", block)
    tables = {1: [0, 0, 0, 0, 0, 6], 2: [0, 1, 2, 3], 3: [0, 0, 2, 2, 4], 4: [0, 1], 5: [5, 1, 1, 1, 1, 1, 1]}
    found = {}
    for r in neardup.open_pairs(opened(spark, tables)).collect():
        found.setdefault((r.table, r.x, r.y), []).append((r.side, r.node))
    met = {}
    for (t, x, y), members in found.items():
        left, right = [n for s, n in members if s == 0], [n for s, n in members if s == 1]
        pairs = itertools.product(left, right) if x < y else itertools.combinations(left, 2)
        for a, b in pairs:
            met[t, min(a, b), max(a, b)] = met.get((t, min(a, b), max(a, b)), 0) + 1
    for t, held in tables.items():
        for a, b in itertools.combinations(range(1, len(held)), 2):
            if held[a] != held[b]:
                assert met[t, 1000 * t + a, 1000 * t + b] == 1
