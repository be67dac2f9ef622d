"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node.

    Alternates large-star and small-star (Kiveris et al., 2014): neighbours are tied to the smallest node around, which
    halves chains and keeps the number of edges. Every round is written to the shared folder, so a lost executor costs a
    round at most. Minima are aggregates, so a node with very many edges is reduced before the shuffle; only the join that
    hands the minimum back meets such a node's edges, where adaptive execution splits them. Self-loops and repeated edges
    are harmless; null ends are dropped.
    """
    current = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        # Large star: each larger neighbour of a node is tied to the smallest of the node and its neighbours.
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: each smaller neighbour, and the node itself, is tied to the smallest neighbour.
        large = settle(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        current = settle(small.distinct(), "small-star")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
