"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.session import settle


def _least(edges: DataFrame) -> DataFrame:
    """Smallest end per start. Written, so that the join with it can split a hot start."""
    return settle(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger end to the smaller one."""
    least = _least(edges)
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of ``edges`` (two columns) but the smallest ones.

    Every step is a per-node minimum or a join with a unique key; no component is gathered in one place. Loops and
    repeated edges are harmless; an edge with a null end takes no part.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = settle(edges.where((a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = state
        now = settle(_small_star(settle(_large_star(now), "large")), "small")
