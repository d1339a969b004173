"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _are_stars(edges: DataFrame) -> bool:
    """True if no node is both a child and a parent, and each child has one parent (parents are smaller)."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    odd = ends.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where("c + p > 1 and c > 0")
    return odd.isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of ``links``; the component is its smallest node.

    Each round hooks neighbours onto the least node near them; a node's
    minimum is a partial aggregate and comes back by a join with a staged table,
    whose hot keys can be split, so that no star is gathered in a task.  The
    edges of a round are written to the shared folder.
    """
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    for _ in range(most_rounds):
        if _are_stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "large-star-edges")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star-edges")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
