"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.sources.tables import keep


def connected(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of links (``a``, ``b``); the root is the smallest node.

    A large star ties the larger neighbours of each node to its smallest neighbour, a
    small star the smaller ones; the number of rounds grows with the logarithm of the
    longest path. Neighbours are never gathered: a step is a minimum per node and a
    join with one row per node, so a node with very many links is no single task's
    work. The edges of each round are written, which also ends their lineage.
    """
    edges = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v")
        .distinct()
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = keep(small)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return keep(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))


def _stars(edges: DataFrame) -> bool:
    """Whether every node either has one edge up, to a node without one, or none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up > 0 and down > 0)").isEmpty()
