"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.scratch import Scratch


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """Links the neighbours of every node to the smallest of them and itself: the larger ones, or the smaller ones and the node."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    linked = pairs.join(low, "u")
    if larger:
        linked = linked.where("v > u")
        return linked.select("low", F.col("v").alias("high")).where("low < high").distinct()
    both = linked.select("low", F.explode(F.array("u", "v")).alias("high"))
    return both.where("low < high").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b), the component being its smallest node.

    Rounds of large and small stars, each written before the next; a node with very many
    neighbours is combined before the shuffle, and its pairs join by Spark's split of large
    partitions. Nodes without an edge to another node are not returned.
    """
    pairs = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct()
    pairs, before, turn = scratch.keep(pairs, f"{name}-0"), None, 0
    while True:
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first()
        if now == before or now[0] == 0:
            return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
                pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )
        before, turn = now, turn + 1
        around = pairs.select(F.col("low").alias("u"), F.col("high").alias("v"))
        around = around.unionAll(around.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(around, larger=True)
        small = _stars(large.select(F.col("high").alias("u"), F.col("low").alias("v")), larger=False)
        pairs = scratch.keep(small, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
