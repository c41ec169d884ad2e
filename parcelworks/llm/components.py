"""Distributed union-find: connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and a join against the
stored minima, so both join inputs are plain exchanges that adaptive execution
can split when one node has very many links.  No step makes more links than it
reads, so repeated ones need no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _is_star(links: DataFrame) -> bool:
    """Whether every node is either a centre or linked to exactly one centre."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("low"), F.col("v").alias("high"), F.lit(0).alias("centre"))
    centres = links.select(F.col("v").alias("node"), F.lit(None), F.lit(None), F.lit(1))
    nodes = ends.union(centres).groupBy("node").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("centre").alias("centre")
    )
    return nodes.where("low < high or (low is not null and centre = 1)").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(
        both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
        "large-min",
    )
    linked = both.where(F.col("v") > F.col("u")).join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "small-min")
    others = links.join(least, "u").where(F.col("v") != F.col("m"))
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Links are undirected; self links and repeated links change nothing; null
    ends are ignored.  An empty table gives an empty result.
    """
    pairs = links.select(F.col(left).alias("u"), F.col(right).alias("v"))
    pairs = pairs.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    current = stored(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    while not _is_star(current):
        large = stored(_large_star(current), "large-star")
        current = stored(_small_star(large), "small-star")
    current = current.distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def merged(roots: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """``roots`` of earlier links after more ``links``; works on the components, not on their nodes."""
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    tops = stored(components(stored(ends.where("a <> b"), "root-links"), "a", "b"), "merged-roots")
    above = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return moved.union(tops.join(roots.select("node"), "node", "left_anti").select("node", "root"))
