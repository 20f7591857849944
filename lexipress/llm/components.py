"""Connected components over edges of longs, by alternating large and small stars.

Each round is two shuffles over the edges; their number grows with the logarithm
of the longest path.  Rounds are written to the shared folder, so lineage stays
short and a lost executor repeats one round at most.  Nothing is collected but the
number of changed edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rounds that any graph of fewer than 2**60 nodes is far from needing.
MOST_ROUNDS = 60


def _least(edges: DataFrame, aggregate) -> DataFrame:
    """(a, root) of each node; grouped by more than ``a``, so that joins by ``a`` shuffle anew
    and Spark can split the edges of a hub over several tasks."""
    return edges.groupBy("a", F.xxhash64("a").alias("_")).agg(aggregate.alias("root")).select("a", "root")


def _star(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node hangs from its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, F.least(F.min("b"), F.min("a")))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours hang from the smallest of them; edges have a > b."""
    least = _least(edges, F.min("b"))
    hung = edges.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return least.select("a", F.col("root").alias("b")).union(hung)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b: long, not null).

    No edges give no rows; loops and repeated edges count once at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = common.materialise(edges, "edges")
    total = _signature(edges)
    for _ in range(MOST_ROUNDS):
        with common.passing():
            large = common.materialise(_star(edges).distinct(), "large-star")
            edges = common.materialise(_small_star(large).distinct(), "small-star", stays=True)
        now = _signature(edges)
        if now == total:
            break
        total = now
    else:
        raise RuntimeError("components did not settle")
    leaves = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return leaves.unionByName(roots.join(leaves.select("node"), "node", "left_anti"))


def _signature(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and two sums of hashes."""
    sums = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) % 1000000007 as decimal(38, 0)))"), F.bit_xor(F.xxhash64("b", "a")))
    with common.shuffles_dropped(edges.sparkSession):
        return tuple(sums.head())
