"""Route completion: pair choice, continuity along a day, time shares and physics.

All candidate pairs of neighbouring pings are known before any route is chosen
(a route that continues starts at a node of this ping's own candidates), so
paths are solved once for the whole table.  What is sequential - which node a
day's next leg starts from - is a small fold over a user-day's legs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions import clock, wkt
from roadflux.functions.bins import speed_limit
from roadflux.operators.paths import path_edges, path_lengths, shortest_paths
from roadflux.storage import materialize

GOOD_ENOUGH, SHORT_EDGE_M = 0.15, 250.0
DAY = ["caid", "date"]


def legs(pings: DataFrame) -> DataFrame:
    """One row per ping but a day's last: its own and the next ping's candidate nodes, time and graph.

    Walks use the walk graph, everything else the drive graph.
    """
    day = Window.partitionBy(*DAY).orderBy("local_timestamp", "ping_seq")
    walks = F.lower("mode") == "caminar"
    own = pings.withColumns({"row": F.row_number().over(day), "graph": F.when(walks, "walk").otherwise("drive")})
    ahead = own.withColumns({"_d": F.lead("nodes_drive").over(day), "_w": F.lead("nodes_walk").over(day), "_t": F.lead("local_timestamp").over(day)})
    out = ahead.where("_t is not null")
    return out.withColumns(
        {
            "starts": F.when(F.col("graph") == "walk", F.col("nodes_walk")).otherwise(F.col("nodes_drive")),
            "ends": F.when(F.col("graph") == "walk", F.col("_w")).otherwise(F.col("_d")),
            "leg_s": clock.seconds_between(F.col("local_timestamp"), F.col("_t")),
            "limit_kmh": speed_limit(F.col("mode")),
        }
    ).drop("_d", "_w", "_t", "nodes_drive", "nodes_walk")


def pairs(legs_: DataFrame) -> DataFrame:
    """(leg columns, i, u, j, v) of all candidate pairs of the legs in trips, u != v, in candidate order."""
    out = legs_.where("trip > 0").select(*DAY, "row", "trip", "graph", "dis_lineal_m", "leg_s", "limit_kmh", F.posexplode("starts").alias("i", "u"), "ends")
    return out.select(*[c for c in out.columns if c != "ends"], F.posexplode("ends").alias("j", "v")).where("u != v")


def score(length: Column, straight: Column) -> Column:
    """Detour: |length / straight - 1|, 0 where the straight distance is 0."""
    return F.abs(F.when(straight > 0, length / straight).otherwise(1.0) - 1)


def scored_pairs(all_pairs: DataFrame, lengths: DataFrame) -> DataFrame:
    """Reachable pairs with score, too_fast and their order in the scan."""
    out = all_pairs.join(lengths, ["graph", "u", "v"])
    speed = F.when(F.col("leg_s") > 0, (F.col("length_m") / 1000) / (F.col("leg_s") / 3600)).otherwise(0.0)
    return out.withColumns({"score": score(F.col("length_m"), F.col("dis_lineal_m")), "too_fast": speed > F.col("limit_kmh"), "place": F.col("i") * 1_000_000 + F.col("j")})


def select_pairs(scored: DataFrame) -> DataFrame:
    """(caid, date, row, u, v, length_m, ideal_s, score, too_fast): without continuity, each leg's choice.

    The first pair in scan order that scores under 0.15, else the least score, the first among equals.
    """
    good = F.col("score") < GOOD_ENOUGH
    rank = F.struct((~good).cast("int").alias("late"), F.when(good, F.lit(0.0)).otherwise(F.col("score")).alias("s"), F.col("place").alias("p"))
    best = scored.groupBy(*DAY, "row").agg(F.min_by(F.struct("u", "v", "length_m", "ideal_s", "score", "too_fast"), rank).alias("b"))
    return best.select(*DAY, "row", "b.*")


def continue_routes(legs_: DataFrame, scored: DataFrame) -> DataFrame:
    """(caid, date, row, u, v, start, too_fast, ideal_s): each leg's choice, with continuity.

    A leg of the same trip as the one before starts where that one ended.
    start: the node the leg begins from if no route is found.
    """
    found = scored.groupBy(*DAY, "row").agg(F.array_sort(F.collect_list(F.struct("place", "u", "v", "score", "too_fast", "ideal_s"))).alias("options"))
    rows = legs_.select(*DAY, "row", "trip", F.try_element_at("starts", F.lit(1)).alias("first")).join(found, [*DAY, "row"], "left")
    rows = rows.withColumns({"caid": F.col("caid").cast("string"), "day": F.col("date").cast("string")})

    def fold(day: pd.DataFrame) -> pd.DataFrame:
        day, out = day.sort_values("row"), []
        last_trip, last_node = None, None
        for row, trip, first, options in day[["row", "trip", "first", "options"]].itertuples(index=False):
            if trip != last_trip:
                last_node = None
            last_trip, best = trip, None
            for option in options if options is not None else ():
                if last_node is not None and option["u"] != last_node:
                    continue
                if best is None or option["score"] < best["score"]:
                    best = option
                    if best["score"] < GOOD_ENOUGH:
                        break
            start = last_node if last_node is not None else first
            start = None if start is None or pd.isna(start) else int(start)
            if best is None:
                out.append((row, None, None, start, None, None))
                last_node = None
            else:
                out.append((row, int(best["u"]), int(best["v"]), start, bool(best["too_fast"]), float(best["ideal_s"])))
                last_node = int(best["v"])
        done = pd.DataFrame(out, columns=["row", "u", "v", "start", "too_fast", "ideal_s"]).astype({"u": "Int64", "v": "Int64", "start": "Int64"})
        return done.assign(caid=day["caid"].iloc[0], day=day["day"].iloc[0])

    schema = "row int, u bigint, v bigint, start bigint, too_fast boolean, ideal_s double, caid string, day string"
    chosen = rows.select("caid", "day", "row", "trip", "first", "options").groupBy("caid", "day").applyInPandas(fold, schema)
    return chosen.withColumn("date", F.to_date("day")).drop("day")


def allocate(steps: DataFrame) -> DataFrame:
    """Time share of every edge of a leg: alloc_s and speed_kmh.

    By travel_time where the path has any (a missing one counts 0 in the path's
    sum but 1 here), else evenly.
    """
    ideal = F.coalesce("travel_time", F.lit(1.0))
    share = F.when(F.col("ideal_s") > 0, F.col("leg_s") * (ideal / F.when(F.col("ideal_s") > 0, F.col("ideal_s")))).otherwise(F.col("leg_s") / F.col("n"))
    out = steps.withColumn("alloc_s", share)
    return out.withColumn("edge_kmh", F.when(F.col("alloc_s") > 0, (F.col("length") / 1000) / (F.when(F.col("alloc_s") > 0, F.col("alloc_s")) / 3600)).otherwise(0.0))


def correct(steps: DataFrame) -> DataFrame:
    """speed_out, distance_m, failed, corrected: short edges that are too fast are capped, long ones voided.

    On a leg that is too fast as a whole every edge is treated so, and a capped
    distance may then exceed the edge.
    """
    fast = F.col("too_fast") | (F.col("edge_kmh") > F.col("limit_kmh"))
    short = F.col("length") <= SHORT_EDGE_M
    return steps.withColumns(
        {
            "speed_out": F.when(~fast, F.col("edge_kmh")).when(short, F.col("limit_kmh")).otherwise(0.0),
            "distance_m": F.when(~fast, F.col("length")).when(short, F.col("limit_kmh") * 1000 / 3600 * F.col("alloc_s")).otherwise(0.0),
            "failed": fast & ~short,
            "corrected": fast & short,
        }
    )


def with_clock(steps: DataFrame) -> DataFrame:
    """edge_time: the leg's start plus the shares of the edges before."""
    before = Window.partitionBy(*DAY, "row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    # every share is rounded by itself, as a clock that is moved on edge by edge
    gone = F.sum(F.round(F.col("alloc_s") * 1e6).cast("bigint")).over(before)
    return steps.withColumn("edge_time", F.timestamp_add("MICROSECOND", F.coalesce(gone, F.lit(0)), F.col("local_timestamp")))


def fallback_rows(legs_: DataFrame, choice: DataFrame, nodes: DataFrame, compat: bool = False) -> DataFrame:
    """One POINT row for legs without a route: routing_error in trips, parada_inactiva in stops.

    The place is the first start candidate's, or the ping's own.  With
    ``compat`` latitude and longitude of stop rows are exchanged, as some consumers expect.
    """
    lost = legs_.join(choice.where("u is null").select(*DAY, "row", "start"), [*DAY, "row"])
    at = nodes.select("graph", F.col("node").alias("start"), F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    lost = lost.join(at, ["graph", "start"], "left").withColumns({"_lon": F.coalesce("_lon", "longitude"), "_lat": F.coalesce("_lat", "latitude")})
    moving = F.col("trip") > 0
    lat = F.when(moving, F.col("_lat")).otherwise(F.col("longitude") if compat else F.col("latitude"))
    lon = F.when(moving, F.col("_lon")).otherwise(F.col("latitude") if compat else F.col("longitude"))
    return lost.select(
        *DAY, "row", F.lit(0).alias("i"), "trip", lat.alias("latitude"), lon.alias("longitude"), F.lit(0.0).alias("speed_kmh"), "local_timestamp",
        F.col("start").cast("string").alias("start_node"), F.try_element_at("ends", F.lit(1)).cast("string").alias("end_node"), F.lit("N/A").alias("osmid"),
        F.when(moving, "routing_error").otherwise("parada_inactiva").alias("highway"), wkt.point(F.col("_lon"), F.col("_lat")).alias("geometry"),
        F.lit(0.0).alias("distance_m"), "mode", moving.alias("failed"), F.lit(False).alias("corrected"),
    )


def edge_rows(legs_: DataFrame, choice: DataFrame, paths: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per edge of every chosen route."""
    facts = legs_.select(*DAY, "row", "trip", "local_timestamp", "leg_s", "limit_kmh", "mode", "graph")
    taken = facts.join(choice.where("u is not null").select(*DAY, "row", "u", "v", "too_fast", "ideal_s"), [*DAY, "row"])
    steps = taken.join(path_edges(paths, edges).drop("_has"), ["graph", "u", "v"]).withColumn("length", F.coalesce("length", F.lit(0.0)))
    steps = with_clock(correct(allocate(steps)))
    place = nodes.select("graph", "node", "lon", "lat")
    steps = steps.join(place.select("graph", F.col("node").alias("a"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")), ["graph", "a"], "left")
    steps = steps.join(place.select("graph", F.col("node").alias("b"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")), ["graph", "b"], "left")
    drawn = F.coalesce("geometry", wkt.line(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2")))
    return steps.select(
        *DAY, "row", "i", "trip", F.col("lat1").alias("latitude"), F.col("lon1").alias("longitude"), F.col("speed_out").alias("speed_kmh"), F.col("edge_time").alias("local_timestamp"),
        F.col("a").cast("string").alias("start_node"), F.col("b").cast("string").alias("end_node"), F.coalesce("osmid", F.lit("N/A")).alias("osmid"),
        F.coalesce("highway", F.lit("unclassified")).alias("highway"), drawn.alias("geometry"), "distance_m", "mode", "failed", "corrected",
    )


def complete_routes(pings: DataFrame, edges: DataFrame, nodes: DataFrame, compat: bool = False) -> DataFrame:
    """pings with trip, mode and candidate nodes to route rows, keyed by (caid, date, row, i)."""
    own = materialize(legs(pings).withColumn("caid", F.col("caid").cast("string")))
    options = pairs(own)
    paths = materialize(shortest_paths(options.select("graph", "u", "v"), edges))
    choice = materialize(continue_routes(own, scored_pairs(options, path_lengths(paths, edges))))
    return edge_rows(own, choice, paths, edges, nodes).unionByName(fallback_rows(own, choice, nodes, compat))
