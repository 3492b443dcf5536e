"""Emissions of route rows: features, rate join with its imputation cascade, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions import bins, clock
from roadflux.functions.bins import POLLUTANTS
from roadflux.storage import materialize

KEYS = ["Day", "Hour", "Road", "Source", "SpeedBin"]
MAX_RATE_ROWS = 200_000


def features(routes: DataFrame) -> DataFrame:
    """routes with Month, Hour, Day, Road, Source, avg_speed_mph, SpeedBin; pure expressions.

    Needs trip, local_timestamp, highway, mode, speed_kmh.
    """
    ts = F.col("local_timestamp")
    out = routes.withColumns(
        {
            "Month": F.month(ts),
            "Hour": bins.hour_1_to_24(ts),
            "Day": bins.day_type(ts),
            "Road": bins.road_class(F.col("highway")),
            "Source": bins.source_id(F.col("trip"), F.col("mode")),
            "avg_speed_mph": F.col("speed_kmh") * bins.MPH,
        }
    )
    return out.withColumn("SpeedBin", bins.speed_bin(F.col("avg_speed_mph")))


def preaggregate(rates: DataFrame) -> DataFrame:
    """One row per key: mean rate of each pollutant, nulls left out."""
    keys = [F.col(k).cast("int").alias(k) for k in KEYS]
    return rates.select(*keys, *POLLUTANTS).groupBy(*KEYS).agg(*[F.avg(p).alias(p) for p in POLLUTANTS])


def curves(means: DataFrame) -> DataFrame:
    """(Source, SpeedBin 1 to 16, pollutants): mean of means, gaps filled from the bin before, then after.

    Each pollutant is filled by itself, along the bins of one Source: 16 rows a window.
    """
    per_bin = means.groupBy("Source", "SpeedBin").agg(*[F.avg(p).alias(p) for p in POLLUTANTS])
    grid = means.select("Source").distinct().withColumn("SpeedBin", F.explode(F.sequence(F.lit(1), F.lit(16))))
    full = grid.join(per_bin, ["Source", "SpeedBin"], "left")
    along = Window.partitionBy("Source").orderBy("SpeedBin")
    back, on = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(0, Window.unboundedFollowing)
    return full.select("Source", "SpeedBin", *[F.coalesce(F.last(p, True).over(back), F.first(p, True).over(on)).alias(p) for p in POLLUTANTS])


def per_source(means: DataFrame) -> DataFrame:
    return means.groupBy("Source").agg(*[F.avg(p).alias(p) for p in POLLUTANTS])


def _small(means: DataFrame) -> bool:
    """Whether the rates are few enough to go to every executor; curves and Source means are smaller still, or 16 rows a Source."""
    return means.limit(MAX_RATE_ROWS + 1).count() <= MAX_RATE_ROWS


def exact_join(featured: DataFrame, means: DataFrame) -> DataFrame:
    """Every route row with its key's rates; rows without a motor get none.

    means has one row a key; the keys are codes (2 x 24 x 2 x sources x 16), so
    its size does not follow the routes'.  It is counted, and broadcast if it is small; else the join shuffles.
    """
    return featured.join(F.broadcast(means) if _small(means) else means, KEYS, "left").withColumns({p: F.when(F.col("Source") > 0, F.col(p)) for p in POLLUTANTS})


def impute(joined: DataFrame, means: DataFrame) -> DataFrame:
    """Gaps of motorised rows: the Source's speed curve, then its mean, then 0; others are 0.

    It happens only if some motorised row lacks the first pollutant; else gaps
    of the others stay null.
    """
    flat = lambda df, tail: df.select(*[F.col(c).alias(f"{c}{tail}") if c in POLLUTANTS else F.col(c) for c in df.columns])
    lacking = joined.where((F.col("Source") > 0) & F.col(POLLUTANTS[0]).isNull()).limit(1).agg((F.count("*") > 0).alias("_lacking"))
    hint = F.broadcast if _small(means) else lambda df: df
    out = joined.join(hint(flat(curves(means), "_curve")), ["Source", "SpeedBin"], "left")
    out = out.join(hint(flat(per_source(means), "_global")), "Source", "left").crossJoin(F.broadcast(lacking))  # one row
    filled = {}
    for p in POLLUTANTS:
        cascade = F.coalesce(p, F.when(F.col("_lacking"), F.coalesce(f"{p}_curve", f"{p}_global", F.lit(0.0))))
        filled[p] = F.when(F.col("Source") > 0, cascade).otherwise(0.0)
    return out.withColumns(filled).drop("_lacking", *[f"{p}_{t}" for p in POLLUTANTS for t in ("curve", "global")])


def totals(rated: DataFrame) -> DataFrame:
    """distance_km_calc, densities (g/km), totals (g) and the map time stamp."""
    out = rated.withColumn("distance_km_calc", F.col("distance_m") / 1000)
    masses = {}
    for p in POLLUTANTS:
        masses[f"Densidad_{p}_g_km"] = F.col(p)
        masses[f"Total_{p}_g"] = F.col(p) * F.col("distance_km_calc")
    return out.withColumns(masses | {"fecha_kepler": clock.stamp(F.col("local_timestamp"))})


def emissions(routes: DataFrame, rates: DataFrame) -> DataFrame:
    """Route rows with rates and totals; the routes themselves are never shuffled."""
    means = materialize(preaggregate(rates))
    return totals(impute(exact_join(features(routes), means), means))
