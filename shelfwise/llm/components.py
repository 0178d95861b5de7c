"""Connected components by alternating large and small stars, every round a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node point to the smallest one around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` for every node with a link: the smallest node it reaches.

    A hub's links stay rows of their own; its smallest neighbour is a partial aggregate, joined back
    with skewed keys split by adaptive execution.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = staged(edges, "links")
    seen = None
    while True:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == seen or not row[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = row
