"""Bins, codes and lookup values of the mode and emission models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain: pollutants, road classes, vehicle sources, speed limits.
POLLUTANTS = ["CO", "CO2", "CO2_Equiv", "HC", "NOx", "PM10", "PM25"]
FAST_ROADS = ["motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link"]
ROAD_FAST, ROAD_OTHER = 4, 5
CAR, BUS, NO_MOTOR = 21, 42, 0
SPEED_LIMITS = {"Caminar": 15.0, "Bus": 100.0, "Metro": 120.0, "Carro": 150.0}
DEFAULT_LIMIT = 150.0
MPH = 0.621371


def digitize(value: Column, edges: list[float]) -> Column:
    """Number of edges <= value; null and NaN fall into the last bin."""
    out = F.lit(len(edges))
    for i in range(len(edges) - 1, -1, -1):
        out = F.when(value < edges[i], i).otherwise(out)
    return out


def speed_bin(mph: Column) -> Column:
    """1 to 16 for 0, 2.5, 7.5, ... 72.5 and up; outside, null, NaN and infinite give 1."""
    inside = (mph >= 2.5) & ~F.isnan(mph) & (mph < float("inf"))
    return F.when(inside, F.least(F.lit(16), F.floor((mph - 2.5) / 5).cast("int") + 2)).otherwise(1).cast("int")


def road_class(highway: Column) -> Column:
    """4 for motorways, trunks and primaries with their links, 5 for all else, unknown and null."""
    return F.when(highway.isin(FAST_ROADS), ROAD_FAST).otherwise(ROAD_OTHER)


def source_id(trip: Column, mode: Column) -> Column:
    """Vehicle source: stops have none; car is tested before bus, so an 'Autobus' is a car."""
    text = F.coalesce(mode.cast("string"), F.lit(""))
    return F.when(trip < 0, NO_MOTOR).when(text.rlike("(?i)carro|auto"), CAR).when(text.rlike("(?i)bus"), BUS).otherwise(NO_MOTOR)


def speed_limit(mode: Column) -> Column:
    out = F.lit(DEFAULT_LIMIT)
    for name, limit in SPEED_LIMITS.items():
        out = F.when(mode == name, limit).otherwise(out)
    return out


def hour_1_to_24(ts: Column) -> Column:
    return F.hour(ts) + 1


def day_type(ts: Column) -> Column:
    """5 from Monday to Friday, 2 at the weekend; a null time counts as weekend."""
    return F.when(F.weekday(ts) < 5, 5).otherwise(2)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
