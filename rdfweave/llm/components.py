"""Connected components by alternating stars, each round staged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rdfweave.llm.common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node move to the least of its neighbourhood.
    Small star: the node and its neighbours below it do.  Edges are (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the pairs (a, b) reaches.

    Ends with stars around the least nodes; the number of rounds grows with the logarithm
    of the longest chain.  Every round is written to the shared folder.
    """
    edges = stage(
        pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        edges = stage(_stars(_stars(edges, True), False), "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
