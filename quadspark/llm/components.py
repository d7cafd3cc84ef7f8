"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch


#: Edges up to which minima, at most two an edge, are broadcast; numbers that a hub's edges are dealt by beyond it.
BROADCAST_EDGES, SALTS = 200_000, 16


def _beside(edges: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    """Edges (u, v) with the minimum ``m`` of their ``u``."""
    if few:
        return edges.join(F.broadcast(least), "u")
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")  # never broadcast by an estimate of its files
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"]).drop("salt")


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has a link.

    ``links`` has long columns ``a`` and ``b``; direction, repeats, self links and nulls don't matter.
    Returns ``node, component``; without links the result is empty. Each step is a grouped minimum, taken in part
    before the shuffle, joined back to the edges; no group is held in memory. Minima of few nodes are broadcast; beyond
    that the join deals edges by node and one of SALTS numbers, so the links of a hub go to many tasks. Each round is written to the
    shared folder, so a lost executor costs no more than the current round.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = scratch.write(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            break
        before, few = now, now[0] <= BROADCAST_EDGES
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _beside(both.where("v > u"), least, few).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _beside(large, least, few).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(small.union(least).where("u != v").distinct(), "edges")
        scratch.discard(edges)
        edges = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
