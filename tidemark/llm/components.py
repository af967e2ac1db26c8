"""Connected components of an undirected graph by alternating stars.

Large-star links every larger neighbour of a node to the least node around
it, small-star every smaller one; a few alternations leave each component a
star round its least node. Hub nodes are never gathered: minima are
combinable aggregates, written out, and joined back as plain scans, which
AQE splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled


def _size(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the least node of its component) for every node of ``edges(u, v)``.

    Loops and repeated edges are ignored; nodes without edges to others are
    not in the result. Nodes are numbers; rows with a null end are ignored.
    Every node first takes the least node around it. Where that leaves edges
    between different labels, those are the components still to be joined,
    as a much smaller graph, by alternating stars.
    """
    edges = edges.where(F.col("u") != F.col("v")).select("u", "v")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    first = settled(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "first")
    one, two = (first.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in "uv")
    across = edges.join(one, "u").join(two, "v").where(F.col("u_label") != F.col("v_label"))
    across = settled(across.select(F.col("u_label").alias("u"), F.col("v_label").alias("v")), "across")
    if across.isEmpty():
        return first
    joined = settled(_stars(across), "joined").select(F.col("node").alias("label"), F.col("label").alias("least"))
    return first.join(joined, "label", "left").select("node", F.coalesce("least", "label").alias("label"))


def _stars(edges: DataFrame) -> DataFrame:
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = settled(edges, "edges"), None
    while (now := _size(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settled(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "large")
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settled(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(own)
