"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._stage import staged


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the least node of its component.

    Each round links every node's larger neighbours, then its smaller ones,
    to the least of them, and writes the edges once; the rounds end when only stars
    around least nodes are left, after about log(longest path) rounds. Nothing
    but a count comes to the driver.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), name)
    while _between(now):
        both = _both(now)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        now = staged(small, name)
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _between(edges: DataFrame) -> int:
    """How many nodes have a smaller neighbour and also another one; without such nodes the edges are stars around least nodes."""
    return (_both(edges).groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
            .filter("least < u and least <> most").count())
