"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**31))), F.lit(0))
    ).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each linked node; component is the smallest node reachable.

    Edges are (a, b) longs. Each round links all larger neighbours of a node to the
    smallest of its neighbourhood, then all smaller ones, until every component is a star
    around its smallest node. A node's minimum is aggregated and joined back, so a node
    with very many links is no one task's work; each round is written to the shared folder.
    """
    edges = saved(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))
        )).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = saved(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
