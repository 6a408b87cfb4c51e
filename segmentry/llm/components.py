"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every node's neighbours are
linked to the least node known among them, until nothing changes. Minima are
pre-aggregated and joined back, so a node with very many edges is never
gathered in one task, and each step is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import materialise


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours (the larger ones, or those up to the node) to the least of them all."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if larger else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = near.join(least, "u")
    out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of every node with an edge; the component is its least node.

    ``edges`` has two columns ``u`` and ``v`` of one orderable type; loops and repeats are fine.
    """
    edges = materialise(edges.filter("u <> v").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    for _ in range(rounds):
        edges = materialise(_star(_star(edges, larger=True), larger=False), "edges")
        now = tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    # Settled: every node points to its component's least node.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
