"""Diagnostic reports, each a small DataFrame.  Route columns: mode, highway, trip, speed_kmh,
distance_m, failed, corrected; emission columns as :mod:`roadflux.operators.emissions` makes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions.bins import POLLUTANTS
from roadflux.operators import ranks

NAMES = {0: "No Motorizado", 21: "Carro", 42: "Bus"}


def _all(total: Column) -> Column:
    """Total over all groups: a window over the few rows of an aggregate."""
    return total.over(Window.partitionBy())


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100 / F.when(whole > 0, whole)).otherwise(0.0)


def record_share(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(column, n, pct): share of records, two digits; ``top``: the largest, ties by name."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    out = out.withColumn("pct", F.bround(F.col("n") * 100.0 / _all(F.sum("n")), 2))
    return out.orderBy(F.desc("n"), column).limit(top) if top else out


def distance_share(routes: DataFrame) -> DataFrame:
    out = routes.where("mode is not null").groupBy("mode").agg(F.sum("distance_m").alias("distance_m"))
    return out.withColumn("pct", F.bround(_percent(F.col("distance_m"), _all(F.sum("distance_m"))), 2)).orderBy(F.desc("distance_m"), "mode")


def routing_success(routes: DataFrame) -> DataFrame:
    """One row: moving rows, failures by cause, success in percent."""
    moving = F.col("trip") > 0
    out = routes.agg(
        F.count_if(moving).alias("moving"),
        F.count_if(moving & F.col("failed")).alias("failures"),
        F.count_if(moving & (F.col("highway") == "routing_error")).alias("topology"),
    )
    failed = _percent(F.col("failures"), F.col("moving"))
    return out.withColumns({"physics": F.col("failures") - F.col("topology"), "failed_pct": failed, "success_pct": 100 - failed})


def correction_share(routes: DataFrame) -> DataFrame:
    moving = F.col("trip") > 0
    out = routes.agg(F.count_if(moving).alias("moving"), F.count_if(moving & F.col("corrected")).alias("corrected_rows"))
    return out.withColumn("corrected_pct", _percent(F.col("corrected_rows"), F.col("moving")))


def describe(df: DataFrame, column: str, percentiles: list[float]) -> DataFrame:
    """One row: count, mean, std (n-1), min, interpolated percentiles (p25, ...), max."""
    out = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))
    out = out.join(ranks.percentiles(df, column, percentiles), F.lit(True), "left")  # one row each
    out = out.withColumns({f"p{round(x * 100)}": F.col("q")[i] for i, x in enumerate(percentiles)})
    return out.select("count", "mean", "std", "min", *[f"p{round(x * 100)}" for x in percentiles], "max")


def corrected_sample(routes: DataFrame, keys: list[str], rows: int = 1000, seed: int = 42) -> DataFrame:
    """At most ``rows`` corrected rows, chosen by the MD5 of the seed and their keys as text: the same rows every time, on any engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    chosen = routes.where("corrected").withColumn("_h", F.md5(text))
    return chosen.orderBy("_h", *keys).limit(rows).drop("_h")


def pure_vs_synthetic(routes: DataFrame) -> DataFrame:
    """One row: kilometres of trips kept as routed, kilometres capped, and their shares."""
    moving = routes.where("trip > 0")
    out = moving.agg(
        (F.coalesce(F.sum(F.when(~F.col("corrected"), F.col("distance_m"))), F.lit(0.0)) / 1000).alias("pure_km"),
        (F.coalesce(F.sum(F.when(F.col("corrected"), F.col("distance_m"))), F.lit(0.0)) / 1000).alias("synthetic_km"),
    )
    total = F.col("pure_km") + F.col("synthetic_km")
    return out.withColumns({"total_km": total, "pure_pct": _percent(F.col("pure_km"), total), "synthetic_pct": _percent(F.col("synthetic_km"), total)})


def source_summary(emitted: DataFrame) -> DataFrame:
    out = emitted.groupBy("Source").agg(F.count("*").alias("records"), F.sum("distance_km_calc").alias("km"))
    name = F.lit("Otro")
    for source, label in NAMES.items():
        name = F.when(F.col("Source") == source, label).otherwise(name)
    return out.withColumns({"name": name, "records_pct": _percent(F.col("records"), _all(F.sum("records"))), "km_pct": _percent(F.col("km"), _all(F.sum("km")))})


def inventory(emitted: DataFrame, without: list[str]) -> DataFrame:
    """(pollutant, grams, kg, pct) in descending order, leaving out the pollutants in ``without``."""
    wanted = [p for p in POLLUTANTS if p not in without]
    sums = emitted.agg(*[F.coalesce(F.sum(f"Total_{p}_g"), F.lit(0.0)).alias(p) for p in wanted])
    out = sums.unpivot([], wanted, "pollutant", "grams")
    return out.withColumns({"kg": F.col("grams") / 1000, "pct": _percent(F.col("grams"), _all(F.sum("grams")))}).orderBy(F.desc("grams"), "pollutant")


def join_quality(emitted: DataFrame) -> DataFrame:
    motor = F.col("Source") > 0
    out = emitted.agg(
        F.count_if(motor).alias("motorised"),
        F.count_if(motor & (F.col("Densidad_CO2_Equiv_g_km") == 0)).alias("orphans"),
        F.count_if(motor & (F.col("distance_m") == 0)).alias("zero_distance"),
    )
    return out.withColumn("success_pct", _percent(F.col("motorised") - F.col("orphans"), F.col("motorised")))


def hourly_profile(emitted: DataFrame, pollutant: str = "CO2_Equiv") -> DataFrame:
    """(Hour 1 to 24, kg): mass of motorised rows by hour of day; hours without any are 0."""
    spark = emitted.sparkSession
    sums = emitted.where("Source > 0").groupBy("Hour").agg((F.sum(f"Total_{pollutant}_g") / 1000).alias("kg"))
    hours = spark.range(1, 25).select(F.col("id").cast("int").alias("Hour"))
    return hours.join(sums, "Hour", "left").select("Hour", F.coalesce("kg", F.lit(0.0)).alias("kg"))


def speed_curve(emitted: DataFrame, pollutant: str = "CO2_Equiv") -> DataFrame:
    return emitted.where("Source > 0").groupBy("SpeedBin").agg(F.avg(f"Densidad_{pollutant}_g_km").alias("g_km"))


def speed_by_mode(routes: DataFrame) -> DataFrame:
    out = routes.groupBy("mode").agg(F.count("speed_kmh").alias("segments"), F.avg("speed_kmh").alias("mean"), F.stddev_samp("speed_kmh").alias("std"), F.min("speed_kmh").alias("min"), F.max("speed_kmh").alias("max"))
    told = ranks.percentiles(routes, "speed_kmh", [0.5, 0.75], ["mode"]).select(F.col("mode").alias("_mode"), F.col("q")[0].alias("median"), F.col("q")[1].alias("p75"))
    out = out.join(F.broadcast(told), F.col("mode").eqNullSafe(F.col("_mode")), "left")  # one row a mode
    return out.select("mode", "segments", *[F.bround(c, 2).alias(c) for c in ("mean", "std", "min", "median", "p75", "max")])


def box_stats(routes: DataFrame) -> DataFrame:
    """Box-plot numbers of speed per mode: quartiles, whiskers within 1.5 IQR, fliers, maximum.

    Quartiles are few rows and joined back by mode, so the second pass is one aggregation too.
    """
    q = ranks.percentiles(routes.where("mode is not null"), "speed_kmh", [0.25, 0.5, 0.75], ["mode"])
    q = q.select("mode", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    low, high = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("speed_kmh").between(low, high)
    rows = routes.select("mode", "speed_kmh").join(F.broadcast(q), "mode")
    return rows.groupBy("mode", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("speed_kmh"))).alias("whisker_low"), F.max(F.when(inside, F.col("speed_kmh"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"), F.max("speed_kmh").alias("max"),
    )


def burst_counts(gaps: DataFrame) -> DataFrame:
    """One row: gaps of at most 1, 5 and 10 seconds, shares of the first two."""
    out = gaps.agg(F.count("*").alias("pings"), *[F.count_if(F.col("gap_s") <= s).alias(f"within_{s}s") for s in (1, 5, 10)])
    return out.withColumns({f"pct_{s}s": _percent(F.col(f"within_{s}s"), F.col("pings")) for s in (1, 5)})


def stage_counts(raw: DataFrame, thinned: DataFrame, filtered: DataFrame, dated: DataFrame) -> DataFrame:
    """One row: rows after each step, share of noise, first and last day kept."""
    out = raw.agg(F.count("*").alias("raw")).crossJoin(thinned.agg(F.count("*").alias("thinned"))).crossJoin(filtered.agg(F.count("*").alias("filtered")))
    out = out.crossJoin(dated.agg(F.count("*").alias("kept"), F.min("date").alias("first_day"), F.max("date").alias("last_day")))  # one row each
    return out.withColumn("noise_pct", _percent(F.col("raw") - F.col("thinned"), F.col("raw")))


def losses(routes: DataFrame) -> DataFrame:
    """One row: user-days, those with a leg that found no route, moving rows and lost ones among them."""
    lost = (F.col("trip") > 0) & F.col("highway").eqNullSafe("routing_error")
    days = routes.groupBy("caid", F.to_date("local_timestamp").alias("_day")).agg(F.count_if(F.col("trip") > 0).alias("moving"), F.count_if(lost).alias("lost"))
    return days.agg(F.count("*").alias("user_days"), F.count_if(F.col("lost") > 0).alias("user_days_with_losses"), F.sum("moving").alias("moving"), F.sum("lost").alias("lost"))
