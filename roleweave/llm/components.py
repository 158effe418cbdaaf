"""Connected components by alternating star contraction, on tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.session import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and root (the least node it is linked with, itself included) of every node of the edges (a, b).

    Each round hooks all larger neighbours of a node to its least neighbour, then all smaller ones; the number of rounds
    grows with the logarithm of the longest path. Every round is a written table, so that its lineage is short. A node
    with very many neighbours is summed up before the shuffle, and the joins that follow have each node once on one side.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = _state(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        hooked = larger.join(least, "a")
        smaller = hooked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        current = stage(smaller.where("a <> b").distinct(), name)
        before, state = state, _state(current)
        if before == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Count and order-free sums that change whenever the edges do."""
    high, low = F.shiftright(F.xxhash64("a", "b"), 32), F.xxhash64("a", "b").bitwiseAND(F.lit(0xFFFFFFFF))
    return tuple(edges.agg(F.count("*"), F.sum(high), F.sum(low)).first())
