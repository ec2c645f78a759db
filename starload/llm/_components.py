"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm._work import Workspace


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b longs); the component
    is its smallest node.

    Each round hooks every node's larger neighbours to its smallest neighbour,
    then its smaller ones.  Both steps are a partially aggregated minimum and a
    join, so a node with any number of links is never gathered in one row.
    Rounds are logarithmic in the longest path; each is staged, so lineage stays
    short.
    """
    edges = ws.stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                                  F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = ws.stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        edges = ws.stage(small, "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ws.stage(leaves.unionByName(roots), "components")
