"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); root is the least node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on the least node around
    it, until only stars are left, after a number of rounds that grows with the logarithm of the
    graph. Rounds are staged in the shared folder. Neighbours are never collected: the least is a partial aggregate,
    and a hub's edges are rows that a join can split.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    before = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        before = state
        now = stage(_small_star(_large_star(now)), "stars")
    raise RuntimeError(f"components are not settled after {rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    moved = edges.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(kept).where("u != v").distinct()
