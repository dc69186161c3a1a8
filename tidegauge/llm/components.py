"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """``u, least``: the smallest of ``u`` and its neighbours ``v``; written, so that a hub's join can be split."""
    return materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "star-least")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); the label is the component's smallest node.

    Edges always point from a node to a smaller one. A step that changes no edge ends the search;
    the number of steps grows with the logarithm of the longest path. Nothing but two sums per step
    reaches the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "star-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(least.select("u", F.col("least").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "small-star")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == before or not row[0]:
            break
        before = tuple(row)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
