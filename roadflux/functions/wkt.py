"""Well-known text of points and lines, read and written by expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def points(wkt: Column) -> Column:
    """array<struct<lon, lat>> of a POINT or LINESTRING, in order; null stays null."""
    pairs = F.regexp_extract_all(wkt, F.lit(f"({_NUMBER})\\s+({_NUMBER})"), F.lit(0))
    return F.transform(pairs, lambda p: F.struct(F.element_at(F.split(p, r"\s+"), 1).cast("double").alias("lon"), F.element_at(F.split(p, r"\s+"), 2).cast("double").alias("lat")))


def parts(wkt: Column) -> Column:
    """array<string> of the single lines of a LINESTRING or MULTILINESTRING."""
    return F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))


def point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def line(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    end = F.concat(lon2.cast("string"), F.lit(" "), lat2.cast("string"), F.lit(")"))
    return F.concat(F.lit("LINESTRING ("), lon1.cast("string"), F.lit(" "), lat1.cast("string"), F.lit(", "), end)
