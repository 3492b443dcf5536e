"""Transport mode of a trip: product of four tables a ping, normalised, summed over the trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions.bins import digitize

# Fixed values of the domain: mode order, bin edges and probability tables.
MODES = ["Carro", "Bus", "Metro", "Caminar"]
STOP = "Parada"
SPEED_EDGES = [6.001, 20.001, 80.001]
DISTANCE_EDGES = [1.0, 6.001, 10.001, 18.001]
AVERAGE_EDGES = [6.001]
NEARNESS = [[0.10, 0.10, 0.80, 0.00], [0.10, 0.80, 0.00, 0.10], [0.40, 0.25, 0.05, 0.30]]
SPEED = [[0.05, 0.10, 0.15, 0.60], [0.47, 0.38, 0.05, 0.10], [0.50, 0.30, 0.20, 0.00], [1.00, 0.00, 0.00, 0.00]]
DISTANCE = [[0.10, 0.20, 0.30, 0.40], [0.25, 0.25, 0.30, 0.20], [0.40, 0.15, 0.25, 0.20], [0.60, 0.30, 0.00, 0.10], [0.40, 0.40, 0.00, 0.20]]
AVERAGE = [[0.10, 0.10, 0.20, 0.60], [0.40, 0.25, 0.25, 0.10]]
TIE_DIGITS = 9


def _entry(row: Column, table: list[list[float]], mode: int) -> Column:
    return F.element_at(F.array(*[F.lit(line[mode]) for line in table]), row + 1)


def classify(pings: DataFrame) -> DataFrame:
    """pings with mode: one of MODES for a trip's rows, 'Parada' for a stop's.

    Needs caid, date, trip, dis_lineal_m, speed_kmh and the two nearness flags.
    Sums are compared at nine digits, since equal modes are equal but for
    the order of summing; of equal modes the first in MODES wins.
    """
    trip = Window.partitionBy("caid", "date", "trip")
    moving = F.col("trip") > 0
    rows = pings.withColumns(
        {
            "_km": F.when(moving, F.sum("dis_lineal_m").over(trip) / 1000).otherwise(0.0),
            "_avg": F.when(moving, F.avg("speed_kmh").over(trip)).otherwise(0.0),
        }
    )
    rows = rows.withColumns(
        {
            "_c": F.when(F.col("near_subway_line") == 1, 0).when(F.col("near_bus_route") == 1, 1).otherwise(2),
            "_v": digitize(F.coalesce("speed_kmh", F.lit(0.0)), SPEED_EDGES),
            "_d": digitize(F.col("_km"), DISTANCE_EDGES),
            "_a": digitize(F.col("_avg"), AVERAGE_EDGES),
        }
    )
    rows = rows.withColumns({f"_p{m}": _entry(F.col("_c"), NEARNESS, m) * _entry(F.col("_v"), SPEED, m) * _entry(F.col("_d"), DISTANCE, m) * _entry(F.col("_a"), AVERAGE, m) for m in range(len(MODES))})
    rows = rows.withColumn("_all", F.col("_p0") + F.col("_p1") + F.col("_p2") + F.col("_p3"))
    rows = rows.withColumn("_all", F.when(F.col("_all") == 0, 1.0).otherwise(F.col("_all")))
    rows = rows.withColumns({f"_s{m}": F.round(F.sum(F.col(f"_p{m}") / F.col("_all")).over(trip), TIE_DIGITS) for m in range(len(MODES))})
    best = F.greatest(*[F.col(f"_s{m}") for m in range(len(MODES))])
    mode = F.when(~moving, STOP)
    for m, name in enumerate(MODES):
        mode = mode.when(F.col(f"_s{m}") == best, name)
    return rows.withColumn("mode", mode).drop("_km", "_avg", "_c", "_v", "_d", "_a", "_all", *[f"_{k}{m}" for k in "ps" for m in range(len(MODES))])
