"""Distributed connected components by alternating large and small stars.

Each round replaces every edge by one towards the smallest neighbour, first
from larger neighbours, then among smaller ones; the edges end as stars around
the smallest node of each component, after a number of rounds that grows with
the logarithm of the longest path.  Minima are partial aggregates and are
written before they are joined back, so a hub with a third of all edges can be
split; every round is a written table, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> ``node, component`` (the smallest node reachable)
    of every node but the smallest ones themselves."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == state or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = mark
        # large star: larger neighbours move to the smallest of the neighbourhood
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        now = materialize(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: the smaller neighbours and the node itself move there
        least = materialize(now.groupBy("a").agg(F.min("b").alias("m")))
        moved = now.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
