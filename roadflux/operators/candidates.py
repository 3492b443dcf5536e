"""k nearest road edges of a point (by edge centroid) and their end nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions.geo import with_utm
from roadflux.operators.proximity import reach_of
from roadflux.sources.readers import line_segments
from roadflux.storage import materialize


def centroids(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(graph, u, v, key, cx, cy): length-weighted middle of each edge, planar metres.

    An edge with a geometry uses its line, others the straight line between their nodes.
    """
    place = with_utm(nodes, "lat", "lon", "px", "py").select("graph", "node", "px", "py")
    ends = edges.join(place.select("graph", F.col("node").alias("u"), F.col("px").alias("x1"), F.col("py").alias("y1")), ["graph", "u"])
    ends = ends.join(place.select("graph", F.col("node").alias("v"), F.col("px").alias("x2"), F.col("py").alias("y2")), ["graph", "v"])
    straight = ends.where("geometry is null").select("graph", "u", "v", "key", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"))
    shaped = edges.where("geometry is not null").withColumn("line_id", F.xxhash64("graph", "u", "v", "key"))
    parts = with_utm(with_utm(line_segments(shaped.select("line_id", "geometry")), "lat1", "lon1", "x1", "y1"), "lat2", "lon2", "x2", "y2")
    size = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    parts = parts.withColumn("w", F.greatest(size, F.lit(1e-9)))
    middle = parts.groupBy("line_id").agg((F.sum((F.col("x1") + F.col("x2")) / 2 * F.col("w")) / F.sum("w")).alias("cx"), (F.sum((F.col("y1") + F.col("y2")) / 2 * F.col("w")) / F.sum("w")).alias("cy"))
    curved = shaped.join(middle, "line_id").select("graph", "u", "v", "key", "cx", "cy")
    return straight.unionByName(curved)


def nearest_edges(points: DataFrame, middles: DataFrame, k: int = 3, cell: float = 400.0) -> DataFrame:
    """(latitude, longitude, edges array<struct<d2, u, v, key>>): the k nearest edges of every distinct place.

    points(latitude, longitude, x, y) are distinct places, middles are of one
    graph.  An edge lies in one grid cell, a place looks into the nine cells
    around it; it is done once its k-th distance is within the looked-at
    square, else it is asked again with doubled cells, up to cells larger than the whole map.  Of the edges met
    only the k nearest are ever gathered: they are ranked, partly before the exchange, not collected.
    Ties go to the lower (u, v, key).
    """
    left, middles, out = materialize(points.where("x is not null and y is not null and not isnan(x) and not isnan(y)")), materialize(middles), None
    total, place = middles.count(), ["latitude", "longitude"]
    size, reach = cell, reach_of((left, ["x"], ["y"]), (middles, ["cx"], ["cy"]))
    nth = F.row_number().over(Window.partitionBy(*place).orderBy("d2", "u", "v", "key"))
    while True:
        grid = middles.withColumns({"gx": F.floor(F.col("cx") / size), "gy": F.floor(F.col("cy") / size)})
        around = F.sequence(F.lit(-1), F.lit(1))
        seen = left.withColumn("ox", F.explode(around)).withColumn("oy", F.explode(around))
        seen = seen.withColumns({"gx": F.floor(F.col("x") / size) + F.col("ox"), "gy": F.floor(F.col("y") / size) + F.col("oy")})
        met = seen.join(grid, ["gx", "gy"])
        met = met.withColumn("d2", (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2)
        first = met.select(*place, "d2", "u", "v", "key").withColumn("_nth", nth).where(F.col("_nth") <= k)
        # the square reaches at least ``size`` beyond the place on every side
        kept = first.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("d2", "u", "v", "key"))).alias("edges"))
        enough = (F.size("edges") >= min(k, total)) & (F.element_at("edges", -1)["d2"] <= size * size)
        done = materialize(kept.where(enough))
        out = done if out is None else out.unionByName(done)
        left = materialize(left.join(done.select(*place), place, "left_anti"))
        if size > reach or left.isEmpty():
            return out
        size *= 2


def candidate_nodes(pings: DataFrame, middles: DataFrame, graph: str, k: int = 3) -> DataFrame:
    """(latitude, longitude, nodes_<graph>): end nodes of the k nearest edges, ascending node ids; middles as by ``centroids``."""
    places = with_utm(pings.select("latitude", "longitude").distinct(), "latitude", "longitude", "x", "y")
    found = nearest_edges(places, middles.where(F.col("graph") == graph).drop("graph"), k)
    both = F.flatten(F.transform("edges", lambda e: F.array(e.u, e.v)))
    return found.select("latitude", "longitude", F.array_sort(F.array_distinct(both)).alias(f"nodes_{graph}"))


def with_candidates(pings: DataFrame, edges: DataFrame, nodes: DataFrame, k: int = 3, middles: DataFrame | None = None) -> DataFrame:
    """pings with nodes_drive and nodes_walk; ``middles``: the projected edges, if they are kept somewhere."""
    middles = centroids(edges, nodes) if middles is None else middles
    for graph in ("drive", "walk"):
        pings = pings.join(candidate_nodes(pings, middles, graph, k), ["latitude", "longitude"], "left")
    return pings
