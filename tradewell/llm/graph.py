"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of an edge.

    Alternates two steps that keep the components: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours and itself. Stars with the smallest node as centre are
    what stays. Rounds grow with the logarithm of the longest path; each is written, so a lost
    executor repeats one round at most.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
                        "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
