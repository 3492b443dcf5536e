"""Distributed connected components by alternating large-star and small-star.

Edges stay in DataFrames throughout.  Each round is one checkpoint plus one
tiny aggregate for the stop test, and the round before it is removed; per-node minima are partially aggregated, and
joins on hub nodes go through :func:`rekey`, so AQE can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflux.storage import release

from .common import checkpointed, rekey

EDGES_PER_TASK = 50_000


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low")).select(rekey("u"), F.least("u", "low").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them (u > v)."""
    low = _minima(edges)
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where("u > v")


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links(u, v)``; component = smallest node.

    Nodes are bigints.  Null ends, self-loops and repeated links are ignored;
    an empty table gives an empty result.  A run that does not settle within
    ``max_rounds`` raises rather than return a partial answer.
    """
    known = links.where("u is not null and v is not null")
    edges = known.select(F.greatest("u", "v").cast("bigint").alias("u"), F.least("u", "v").cast("bigint").alias("v"))
    edges = checkpointed(edges.where("u > v").distinct())
    seen = None
    for _ in range(max_rounds):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        # rounds do not add edges; few edges need few tasks and few files
        parts = max(1, -(-mark[0] // EDGES_PER_TASK))
        before, edges = edges, checkpointed(_small_star(_large_star(edges)).distinct().coalesce(parts))
        release(before)
    else:
        raise RuntimeError("connected components did not settle")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
