"""Shortest road paths for a set of origin-destination pairs.

Pairs are distinct over the whole table and solved once per (graph, origin).
While the graph is within ``max_edges`` (counted first) its adjacency goes to the
executors and each origin is one Dijkstra run; beyond that, distances are
relaxed in joins, so nothing is broadcast.  Both order paths by length, then by
number of edges, then by the lower predecessor, so they find the same paths; as every
edge adds to (length, edges), edges of no length make no cycle of predecessors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflux.storage import materialize, release

MAX_EDGES = 2_000_000
PATH = "graph string, u bigint, v bigint, path array<bigint>"


def usable(edges: DataFrame) -> DataFrame:
    """Distinct (graph, u, v, length): the shortest of parallel edges; edges without a length count 0."""
    return edges.groupBy("graph", "u", "v").agg(F.min(F.coalesce("length", F.lit(0.0))).alias("length"))


class Roads:
    """One graph's edges as flat arrays, 16 bytes an edge, so that a broadcast stays small."""

    def __init__(self, u: np.ndarray, v: np.ndarray, length: np.ndarray) -> None:
        order = np.lexsort((v, u))
        self.to, self.length = v[order], length[order]
        self.nodes, self.first = np.unique(u[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))

    def leaving(self, node: int) -> Iterator[tuple[int, float]]:
        at = int(np.searchsorted(self.nodes, node))
        if at == len(self.nodes) or self.nodes[at] != node:
            return iter(())
        lo, hi = self.first[at], self.last[at]
        return zip(self.to[lo:hi].tolist(), self.length[lo:hi].tolist(), strict=True)


def dijkstra(roads: Roads, origin: int, goals: set[int]) -> dict[int, list[int]]:
    """Node paths to the reachable goals; among equal lengths fewer edges, then the lower predecessor."""
    best, before, done = {origin: (0.0, 0)}, {origin: -1}, set()
    queue, missing = [(0.0, 0, origin)], set(goals)
    while queue and missing:
        far, hops, node = heapq.heappop(queue)
        if node in done:
            continue
        done.add(node)
        missing.discard(node)
        for to, length in roads.leaving(node):
            reach = far + length, hops + 1
            if to not in done and (to not in best or (reach, node) < (best[to], before[to])):
                best[to], before[to] = reach, node
                heapq.heappush(queue, (*reach, to))
    out = {}
    for goal in goals & done:
        path = [goal]
        while path[-1] != origin:
            path.append(before[path[-1]])
        out[goal] = path[::-1]
    return out


def shortest_paths(pairs: DataFrame, edges: DataFrame, max_edges: int = MAX_EDGES) -> DataFrame:
    """(graph, u, v, path) of pairs(graph, u, v) that are reachable and not u = v."""
    wanted = pairs.select("graph", F.col("u").cast("bigint"), F.col("v").cast("bigint")).where("u != v").distinct()
    roads = usable(edges)
    if roads.count() > max_edges:
        return relaxed_paths(wanted, roads)
    table = roads.toPandas()  # at most max_edges rows
    graphs = {name: Roads(own["u"].to_numpy(), own["v"].to_numpy(), own["length"].to_numpy()) for name, own in table.groupby("graph")}
    shared = pairs.sparkSession.sparkContext.broadcast(graphs)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for graph, u, goals in batch.itertuples(index=False):
                if graph in shared.value:
                    rows += [(graph, u, v, path) for v, path in dijkstra(shared.value[graph], u, {int(g) for g in goals}).items()]
            yield pd.DataFrame(rows, columns=["graph", "u", "v", "path"])

    return wanted.groupBy("graph", "u").agg(F.collect_list("v").alias("goals")).mapInPandas(solve, PATH)


def relaxed_paths(wanted: DataFrame, roads: DataFrame, rounds: int = 100_000) -> DataFrame:
    """The same by relaxing distances from all origins at once, one join a round.

    Nothing is followed beyond the farthest goal of an origin once all its goals are
    reached.  A search that ``rounds`` do not end raises; there are no partial answers.
    """
    label = ["far", "hops", "before"]
    steps = roads.select("graph", F.col("u").alias("at"), F.col("v").alias("to"), "length")
    start = wanted.select("graph", "u").distinct()
    known = materialize(start.select("graph", "u", F.col("u").alias("at"), F.lit(0.0).alias("far"), F.lit(0).alias("hops"), F.lit(-1).cast("bigint").alias("before")))
    front, waste = known, []
    for _ in range(rounds):
        reach = front.join(steps, ["graph", "at"]).select("graph", "u", F.col("to").alias("at"), (F.col("far") + F.col("length")).alias("far"), (F.col("hops") + 1).alias("hops"), F.col("at").alias("before"))
        best = reach.unionByName(known).groupBy("graph", "u", "at").agg(F.min(F.struct(*label)).alias("b"))
        best = materialize(best.select("graph", "u", "at", *[f"b.{x}" for x in label]))
        ends = wanted.join(best.select("graph", "u", F.col("at").alias("v"), "far"), ["graph", "u", "v"], "left")
        limit = ends.groupBy("graph", "u").agg(F.when(F.count("*") == F.count("far"), F.max("far")).alias("limit"))
        moved = best.join(known, ["graph", "u", "at", *label], "left_anti").join(limit, ["graph", "u"])
        front = materialize(moved.where("limit is null or far <= limit").drop("limit"))
        for old in waste:
            release(old)
        waste, known = [known, front], best
        if front.isEmpty():
            break
    else:
        raise RuntimeError("shortest paths did not settle")
    reached = wanted.join(known.select("graph", "u", F.col("at").alias("v"), F.col("before").alias("_b")), ["graph", "u", "v"])
    walk = reached.select("graph", "u", "v", F.array("v").alias("path"), F.col("_b").alias("at"))
    done = None
    for _ in range(rounds):
        ended = walk.where("at = -1").select("graph", "u", "v", "path")
        done = ended if done is None else done.unionByName(ended)
        walk = walk.where("at != -1").join(known.select("graph", "u", "at", "before"), ["graph", "u", "at"])
        walk = materialize(walk.select("graph", "u", "v", F.concat(F.array("at"), "path").alias("path"), F.col("before").alias("at")))
        if walk.isEmpty():
            return done
    raise RuntimeError("paths could not be walked back")


def path_edges(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph, u, v, i, a, b, n + attributes of edge (a, b) with key 0), n: number of edges of the path."""
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.element_at("path", i).alias("a"), F.element_at("path", i + 1).alias("b")))
    each = paths.where(F.size("path") > 1).select("graph", "u", "v", (F.size("path") - 1).alias("n"), F.posexplode(steps).alias("i", "s"))
    first = edges.where("key = 0").select("graph", F.col("u").alias("a"), F.col("v").alias("b"), "length", "travel_time", "osmid", "highway", "geometry")
    each = each.select("graph", "u", "v", "n", "i", "s.a", "s.b")
    return each.join(first.withColumn("_has", F.lit(True)), ["graph", "a", "b"], "left")


def path_lengths(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph, u, v, length_m, ideal_s): sums over key-0 edges; a path that lacks one is left out.

    A missing travel_time counts 0 in the sum.
    """
    each = path_edges(paths, edges)
    out = each.groupBy("graph", "u", "v").agg(F.sum(F.coalesce("length", F.lit(0.0))).alias("length_m"), F.sum(F.coalesce("travel_time", F.lit(0.0))).alias("ideal_s"), F.count("_has").alias("_k"), F.max("n").alias("_n"))
    return out.where("_k = _n").drop("_k", "_n")


__all__ = ["dijkstra", "path_edges", "path_lengths", "relaxed_paths", "shortest_paths", "usable"]
