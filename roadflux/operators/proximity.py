"""Nearness of pings to transit lines: radius test and exact nearest line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflux.functions.geo import segment_distance, with_utm
from roadflux.sources.readers import line_segments
from roadflux.storage import materialize

RADIUS_M = 100.0


def planar_segments(lines: DataFrame) -> DataFrame:
    """(line_id, seq, x1, y1, x2, y2) in metres of lines(line_id, geometry)."""
    out = with_utm(with_utm(line_segments(lines), "lat1", "lon1", "x1", "y1"), "lat2", "lon2", "x2", "y2")
    # materialised: filters on the distance would otherwise repeat the projection inside their own expressions
    return materialize(out.select("line_id", "seq", "x1", "y1", "x2", "y2"))


def _cells(segments: DataFrame, size: float) -> DataFrame:
    """Segments with every grid cell that lies within ``size`` of them.

    A segment is cut into pieces of a cell's length, and the cells around each piece's box are
    taken once, so a long diagonal is entered along its course and not all over its box.
    """
    cell = lambda value: F.floor(value / size)
    n = F.greatest(F.ceil(F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2) / size), F.lit(1))
    at = lambda i, a, b: F.col(a) + (F.col(b) - F.col(a)) * i / F.col("_n")
    span = lambda i, a, b: F.sequence(cell(F.least(at(i, a, b), at(i + 1, a, b))) - 1, cell(F.greatest(at(i, a, b), at(i + 1, a, b))) + 1)
    low = (1 << 32) - 1
    # both numbers in one, as arrays of numbers are made distinct by hashing
    keys = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.flatten(F.transform(span(i, "x1", "x2"), lambda cx: F.transform(span(i, "y1", "y2"), lambda cy: F.shiftleft(cx, 32).bitwiseOR(cy.bitwiseAND(F.lit(low)))))))
    out = segments.withColumn("_n", n.cast("int")).withColumn("_key", F.explode(F.array_distinct(F.flatten(keys))))
    out = out.withColumns({"cx": F.shiftright("_key", 32), "cy": F.shiftright(F.shiftleft("_key", 32), 32)}).drop("_n", "_key")
    # a piece's box has corners: keep cells whose centre is near enough to matter
    centre = segment_distance((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return out.where(centre <= size * (2**0.5 / 2 + 1) + 1e-6)


def reach_of(*tables: tuple[DataFrame, list[str], list[str]]) -> float:
    """A length beyond the distance of any two places of the tables(frame, x columns, y columns); 0 if there are none."""
    found: dict[str, list[float]] = {"x": [], "y": []}
    for df, xs, ys in tables:
        row = df.agg(*[e for c in xs + ys for e in (F.min(c), F.max(c))]).first()
        for i, c in enumerate(xs + ys):
            found["x" if c in xs else "y"] += [v for v in row[2 * i : 2 * i + 2] if v is not None]
    return max((max(v) - min(v) for v in found.values() if v), default=0.0) * 2


def within(points: DataFrame, segments: DataFrame, key: list[str], radius: float = RADIUS_M) -> DataFrame:
    """Distinct ``key`` of points(x, y) closer than ``radius`` (strict) to a segment.

    An equi-join on grid cells of the radius' size: a segment is entered in every
    cell that it can reach, a point in its own cell only.
    """
    grid = _cells(segments, radius)
    spots = points.withColumns({"cx": F.floor(F.col("x") / radius), "cy": F.floor(F.col("y") / radius)})
    met = spots.join(grid, ["cx", "cy"])
    near = segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]) < radius
    return met.where(near).select(*key).distinct()


def flag_infrastructure(pings: DataFrame, subway: DataFrame, bus: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """pings with near_subway_line and near_bus_route (0 or 1).

    Only distinct places are tested, so a place visited a million times costs one test.
    """
    places = materialize(with_utm(pings.select("latitude", "longitude").distinct(), "latitude", "longitude", "x", "y"))
    out = pings
    for name, lines in (("near_subway_line", subway), ("near_bus_route", bus)):
        near = within(places, planar_segments(lines), ["latitude", "longitude"], radius).withColumn(name, F.lit(1))
        out = out.join(near, ["latitude", "longitude"], "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def nearest_line(points: DataFrame, segments: DataFrame, key: str, cell: float = 500.0) -> DataFrame:
    """(key, line_id, distance_m): the nearest line of every point, the lowest id among equals.

    Cells double until a line lies within the cell's size, which makes it
    certainly the nearest; the last cells are larger than the whole map, so every point finds its line at any distance.  Without segments
    or coordinates the line is null.
    """
    every, out = materialize(points.select(key, "x", "y")), None
    left = every.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    size, reach = cell, reach_of((left, ["x"], ["y"]), (segments, ["x1", "x2"], ["y1", "y2"]))
    while not left.isEmpty():
        grid = _cells(segments, size)
        met = left.withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)}).join(grid, ["cx", "cy"])
        met = met.withColumn("distance_m", segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")])).where(F.col("distance_m") <= size)
        found = met.groupBy(key).agg(F.min(F.struct("distance_m", "line_id")).alias("b")).select(key, F.col("b.line_id").alias("line_id"), F.col("b.distance_m").alias("distance_m"))
        found = materialize(found)
        out = found if out is None else out.unionByName(found)
        if size > reach:
            break
        left, size = materialize(left.join(found.select(key), key, "left_anti")), size * 2
    if out is None:
        return every.select(key, F.lit(None).cast(segments.schema["line_id"].dataType).alias("line_id"), F.lit(None).cast("double").alias("distance_m"))
    return every.select(key).join(out, key, "left")
