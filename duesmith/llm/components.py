"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesmith.sources.workspace import stored


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.hash("a", "b"))).first())


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``node, root`` for every node of an edge ``a, b`` between different nodes; the root is the smallest.

    Each round replaces a node's edges by edges to the smallest node that it can see, which needs
    about as many rounds as the logarithm of the longest path.  Rounds are joins and sums, stored
    in the shared folder, so a hub with very many edges is split like any other join key.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    sign = _sign(edges)
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()  # every edge now points from the larger to the smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "edges")
        before, sign = sign, _sign(edges)
        if sign == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
