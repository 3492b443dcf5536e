"""Ping preparation: clock, sample, downsampling, fence, sparse ids, whole days, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions import clock
from roadflux.functions.geo import haversine_km
from roadflux.sources.readers import time_column

CENTRE_LAT, CENTRE_LON, RADIUS_KM = 25.6866, -100.3161, 48.0
BUCKET_S, MAX_KMH = 10, 150.0


def normalize_time(pings: DataFrame, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    """The raw time column becomes local_timestamp, naive local time."""
    name = time_column(pings)
    local = clock.to_local(clock.utc_instant(pings, name), zone)
    return pings.withColumn(name, local).withColumnRenamed(name, "local_timestamp")


def sample_users(pings: DataFrame, users: int | None = 4) -> DataFrame:
    """Rows of the first ``users`` ids in file order; None keeps all."""
    if users is None:
        return pings
    first = pings.where("caid is not null").groupBy("caid").agg(F.min("ping_seq").alias("first")).orderBy("first").limit(users)
    return pings.join(F.broadcast(first.select("caid")), "caid", "left_semi")  # at most ``users`` rows


def downsample(pings: DataFrame, seconds: int = BUCKET_S) -> DataFrame:
    """The last ping of every (id, window of ``seconds`` on the local clock).

    A maximum over structs: it is partly aggregated before the shuffle, so an id
    with very many pings costs no more than its windows.
    """
    rest = [c for c in pings.columns if c not in ("caid", "local_timestamp", "ping_seq")]
    row = F.struct("local_timestamp", "ping_seq", *[F.col(f"`{c}`") for c in rest])
    last = pings.groupBy("caid", clock.bucket(F.col("local_timestamp"), seconds).alias("_bucket")).agg(F.max_by(row, F.struct("local_timestamp", "ping_seq")).alias("_row"))
    return last.select("caid", "_row.*").select(*[F.col(f"`{c}`") for c in pings.columns])


def geofence(pings: DataFrame, lat: float = CENTRE_LAT, lon: float = CENTRE_LON, radius_km: float = RADIUS_KM) -> DataFrame:
    distance = haversine_km(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return pings.withColumn("Distance", distance).where(F.col("Distance") < radius_km)


def drop_sparse_ids(pings: DataFrame, threshold: int = 2) -> DataFrame:
    """Rows of ids that have more than ``threshold`` rows."""
    dense = pings.groupBy("caid").count().where(F.col("count") > threshold).select("caid")
    return pings.join(dense, "caid", "left_semi")


def whole_days(pings: DataFrame) -> DataFrame:
    """Adds date; with three dates or more in the whole table, the first and the last are dropped."""
    dated = pings.withColumn("date", F.to_date("local_timestamp"))
    days = dated.select("date").distinct().agg(F.count("date").alias("_n"), F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    inside = (F.col("date") > F.col("_lo")) & (F.col("date") < F.col("_hi"))
    return dated.crossJoin(F.broadcast(days)).where((F.col("_n") < 3) | inside).drop("_n", "_lo", "_hi")  # days is one row


def vectors(pings: DataFrame, max_kmh: float = MAX_KMH) -> DataFrame:
    """Step to the next ping of the same id and day: dis_lineal_m and speed_kmh; too fast steps go.

    After downsampling a user-day has at most 8,640 rows, so a day is a bounded window.
    """
    day = Window.partitionBy("caid", "date").orderBy("local_timestamp", "ping_seq")
    ahead = pings.withColumns({"_lat": F.lead("latitude").over(day), "_lon": F.lead("longitude").over(day), "_ts": F.lead("local_timestamp").over(day)})
    ahead = ahead.dropna(subset=["_lat", "_lon", "_ts"])
    metres = haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")) * 1000
    out = ahead.withColumns({"dis_lineal_m": metres, "_s": clock.seconds_between(F.col("local_timestamp"), F.col("_ts"))})
    out = out.withColumn("speed_kmh", F.when(F.col("_s") > 0, (F.col("dis_lineal_m") / 1000) / (F.col("_s") / 3600)).otherwise(0.0))
    return out.where(F.col("speed_kmh") <= max_kmh).drop("_lat", "_lon", "_ts", "_s", "Distance")


def travel_times(steps: DataFrame) -> DataFrame:
    """travel_s: seconds to the next ping that is still there, 0 at a day's end."""
    day = Window.partitionBy("caid", "date").orderBy("local_timestamp", "ping_seq")
    gap = clock.seconds_between(F.col("local_timestamp"), F.lead("local_timestamp").over(day))
    return steps.withColumn("travel_s", F.coalesce(gap, F.lit(0.0)))


def prepare(pings: DataFrame, users: int | None = None) -> DataFrame:
    """Raw pings to steps with speed, distance and travel time."""
    local = downsample(sample_users(normalize_time(pings), users))
    return travel_times(vectors(whole_days(drop_sparse_ids(geofence(local)))))


def gaps(pings: DataFrame) -> DataFrame:
    """Raw pings (UTC clock) with gap_s, the seconds since the same id's ping before; first pings go.

    The window is the id's hour; hours are then joined end to end over one row an
    hour, so an id with any number of pings is never one task.
    """
    name = time_column(pings)
    rows = pings.withColumn("ts_utc", clock.utc_instant(pings, name)).withColumn("_hour", F.date_trunc("hour", "ts_utc"))
    hour = Window.partitionBy("caid", "_hour").orderBy("ts_utc", "ping_seq")
    rows = rows.withColumn("_before", F.lag("ts_utc").over(hour))
    hours = rows.groupBy("caid", "_hour").agg(F.max("ts_utc").alias("_last"))
    ends = hours.withColumn("_carry", F.lag("_last").over(Window.partitionBy("caid").orderBy("_hour"))).drop("_last")
    first = rows.where("_before is null").join(ends, ["caid", "_hour"]).withColumn("_before", F.col("_carry")).drop("_carry")
    both = rows.where("_before is not null").unionByName(first)
    both = both.withColumn("gap_s", clock.seconds_between(F.col("_before"), F.col("ts_utc")))
    return both.where("gap_s is not null").drop("_before", "_hour")
