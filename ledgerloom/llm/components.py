"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; component is its smallest node.

    Alternates two steps until all components are stars: every node's larger neighbours are
    hung onto its smallest neighbour, then its smaller ones. Each step keeps the
    components and brings every node nearer to its smallest; a chain of n nodes
    takes about log n rounds. Minima are combined before the shuffle and the joins
    have plain exchanges on both sides, which adaptive execution splits for a node
    with very many links. Each round is stored, so a lost executor costs a round.
    """
    edges = stored(
        links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .filter(F.col("u") != F.col("v")).distinct()
    )
    while not _stars(edges):
        edges = stored(_small_star(stored(_large_star(edges))))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node that hangs on another hangs on one, and nothing hangs on it."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sides = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sides.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    hung = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # u > v in every edge, so the neighbours are the smaller ones.
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
