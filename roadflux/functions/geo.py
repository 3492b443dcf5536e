"""Spherical and planar geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (p2 - p1) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    a = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), F.lit(2))
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))


# WGS84 and UTM zone 14 north
_A, _F = 6378137.0, 1 / 298.257223563
_K0, _EASTING, _MERIDIAN = 0.9996, 500000.0, -99.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def with_utm(df: DataFrame, lat: str, lon: str, x: str, y: str) -> DataFrame:
    """df with planar metres (transverse Mercator, three-term Krueger series) in columns ``x`` and ``y``."""
    df = df.withColumns({"_s": F.sin(F.radians(lat)), "_l": F.radians(F.col(lon) - _MERIDIAN)})
    df = df.withColumn("_t", F.sinh(F.atanh("_s") - _ECC * F.atanh(_ECC * F.col("_s"))))
    df = df.withColumns({"_xi": F.atan2(F.col("_t"), F.cos("_l")), "_eta": F.atanh(F.sin("_l") / F.sqrt(1 + F.col("_t") * F.col("_t")))})
    east, north = F.col("_eta"), F.col("_xi")
    for j, alpha in enumerate(_ALPHA, 1):
        east = east + alpha * F.cos(2 * j * F.col("_xi")) * F.sinh(2 * j * F.col("_eta"))
        north = north + alpha * F.sin(2 * j * F.col("_xi")) * F.cosh(2 * j * F.col("_eta"))
    df = df.withColumns({x: F.lit(_EASTING) + _K0 * _RADIUS * east, y: F.lit(_K0 * _RADIUS) * north})
    return df.drop("_s", "_l", "_t", "_xi", "_eta")


def along_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Share (0 to 1) of the segment at the point nearest to p; 0 for a segment of no length."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = ((px - x1) * dx + (py - y1) * dy) / F.when(square > 0, square)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), F.lit(0.0))


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance from a point to a segment."""
    t = along_segment(px, py, x1, y1, x2, y2)
    ex, ey = x1 + t * (x2 - x1) - px, y1 + t * (y2 - y1) - py
    return F.sqrt(ex * ex + ey * ey)
