"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (those above it, or itself and those below) to the least one it sees."""
    c = F.col
    both = edges.select(c("a").alias("u"), c("b").alias("v"))
    if large:
        both = both.union(edges.select(c("b").alias("u"), c("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), c("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        made = joined.where("v > u").select(c("v").alias("a"), c("m").alias("b"))
    else:
        made = joined.select(c("v").alias("a"), c("m").alias("b")).union(least.select(c("u").alias("a"), c("m").alias("b")))
    return made.where("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or linked to one centre only."""
    c = F.col
    roles = edges.select(c("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre"))
    roles = roles.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return roles.where((c("out") > 1) | ((c("out") == 1) & (c("centre") == 1))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, label (least node of its component) for every node of `edges` (a, b).

    Nodes with many links take part as sums only: rows are pairs of a node and the least one it is linked to, so
    their number never grows. Each round is stored; a lost executor costs no more than one.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(edges):
        edges = stored(_star(stored(_star(edges, True), "large"), False), "small")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.union(leaves.select("label", "label").distinct())
