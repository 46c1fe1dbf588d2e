"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.session import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): ``label`` is the smallest node reachable.

    Each round points every node and its larger neighbours to the smallest neighbour (large star), then every
    node's smaller neighbours to the smallest (small star), until nothing moves. A round is two joins of the
    link table with one minimum per node; no neighbour list is ever gathered. NULL ends and loops are no links.
    """
    edges = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = scratch.keep(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        down = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch.keep(down.select("a", F.col("m").alias("b")).unionByName(small).distinct())
        same = after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
