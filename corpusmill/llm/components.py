"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every node of ``links``; comp is its component's smallest node.

    Alternating large and small stars: a node hands the smallest neighbour on
    to its larger neighbours, then to its smaller ones, until each component
    is one star. Nodes never gather their neighbours; only minima are
    aggregated, and each round is written to the shared folder. Null nodes
    have no links; repeated links and links of a node to itself are harmless.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = materialise(edges, "links")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u > v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
            .union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every larger node has one link, to a node that has none to a smaller one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
                        .alias("e")).select("e.*")
    roles = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count() == 0
