"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (x, y); the component is its smallest node.

    Alternating large and small stars: each node's larger neighbours, then its smaller ones, are
    linked to the smallest node around.  Rounds end when the links no longer change, after about
    the logarithm of the longest chain; every round is written to the shared folder.  A node
    with very many links is only ever a key of partial aggregates and of joins that split.
    """
    edges = written(links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if now == mark:
            break
        mark = now
        edges = written(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
