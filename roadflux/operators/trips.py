"""Trips and stops by window composition; no row-at-a-time state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STOP_KMH, STOP_S, TELEPORT_S, STILL_M = 3.0, 300.0, 1800.0, 100.0


def assign_trips(steps: DataFrame) -> DataFrame:
    """steps with ``trip``: positive ids are trips, negative ids are stops.

    A row is a teleport (T: travel time over 1800 s), still (S: under 3 km/h and
    100 m) or moving (M).  Still time adds up since the last T or M; beyond 300 s
    the row is in a stop.  T always opens a stop, M opens a trip unless one is
    open, a long S opens a stop unless one is open, any other S continues what
    is there (trip 1 at the start of a day, without counting).  All of it is
    running sums over one partitioning and order: one exchange, one sort.
    """
    day = Window.partitionBy("caid", "date").orderBy("local_timestamp", "ping_seq")
    upto = day.rowsBetween(Window.unboundedPreceding, 0)
    before = day.rowsBetween(Window.unboundedPreceding, -1)
    tt, speed, metres = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("travel_s", "speed_kmh", "dis_lineal_m"))
    kind = F.when(tt > TELEPORT_S, "T").when((speed < STOP_KMH) & (metres < STILL_M), "S").otherwise("M")
    rows = steps.withColumn("_k", kind).withColumn("_g", F.sum(F.when(F.col("_k") != "S", 1).otherwise(0)).over(upto))
    still = F.sum(F.when(F.col("_k") == "S", tt).otherwise(0.0))
    run = Window.partitionBy("caid", "date", "_g").orderBy("local_timestamp", "ping_seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_long", (F.col("_k") == "S") & (still.over(run) > STOP_S))
    rows = rows.withColumn("_sign", F.when((F.col("_k") == "T") | F.col("_long"), -1).when(F.col("_k") == "M", 1))
    rows = rows.withColumns({"_now": F.coalesce(F.last("_sign", True).over(upto), F.lit(1)), "_was": F.last("_sign", True).over(before), "_n": F.row_number().over(day)})
    was = F.when(F.col("_n") == 1, 0).otherwise(F.coalesce("_was", F.lit(1)))
    opens_stop = (F.col("_k") == "T") | (F.col("_long") & (was >= 0))
    opens_trip = (F.col("_k") == "M") & (was <= 0)
    rows = rows.withColumns({"_stops": F.sum(opens_stop.cast("int")).over(upto), "_trips": F.sum(opens_trip.cast("int")).over(upto)})
    trip = F.when(F.col("_now") > 0, F.greatest("_trips", F.lit(1))).otherwise(-F.col("_stops")).cast("int")
    return rows.withColumn("trip", trip).drop("_k", "_g", "_long", "_sign", "_now", "_was", "_n", "_stops", "_trips")
