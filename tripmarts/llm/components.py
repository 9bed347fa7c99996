"""Connected components of a link table by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import kept


def components(links: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of a link.

    Large stars link every larger neighbour of a node to the node's smallest neighbour, small
    stars every smaller one; the links end as stars around the smallest nodes. Links stay as many
    or become fewer, all groupings are minima with a map-side part, and rounds grow with the
    logarithm of the longest path. Every round is a table in the shared folder.
    """
    edges = links.select(F.col(source).alias("a"), F.col(target).alias("b")).filter("a <> b")
    edges = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    edges = kept(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("high").alias("low"), F.col("low").alias("high")))
        near = both.groupBy(F.col("low").alias("node")).agg(F.min("high").alias("near"))
        near = near.select("node", F.least("node", "near").alias("root"))
        # Large star: node's larger neighbours go to the node's root.
        large = edges.join(near, edges["low"] == near["node"]).select(F.col("root").alias("low"), "high")
        large = large.filter("low <> high").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        root = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
        small = large.join(root, large["high"] == root["node"]).select("root", "low", "node")
        moved = small.select(F.col("root").alias("low"), F.col("low").alias("high"))
        moved = moved.union(small.select(F.col("root").alias("low"), F.col("node").alias("high")))
        edges = kept(moved.filter("low <> high").distinct(), "links")
        total = edges.agg(
            F.count("*").alias("links"),
            F.sum(F.hash("low", "high").cast("long")).alias("sum"),
            F.bit_xor(F.xxhash64("low", "high")).alias("mix"),
        ).first()
        if state == total:
            break
        state = total
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
