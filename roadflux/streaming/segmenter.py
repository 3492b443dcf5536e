"""Streaming forms of downsampling and trip segmentation.

Both give what the batch operators give once a day is complete.  The segmenter takes a user's
pings in time order; one that comes after a later one of its user was taken is left out, as
its steps have been given already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadflux.functions.geo import EARTH_KM
from roadflux.operators.prep import MAX_KMH
from roadflux.operators.trips import STILL_M, STOP_KMH, STOP_S, TELEPORT_S

OUTPUT = "caid string, day string, ping_seq bigint, dis_lineal_m double, speed_kmh double, travel_s double, trip int"
STATE = "day string, last_us bigint, last_seq bigint, last_lat double, last_lon double, held_us bigint, held_seq bigint, held_m double, held_kmh double, trip int, trips int, stops int, still double"
_EMPTY = ("", 0, -1, 0.0, 0.0, 0, -1, 0.0, 0.0, 0, 0, 0, 0.0)


def downsample_stream(pings: DataFrame, seconds: int = 10, late: str = "1 minute") -> DataFrame:
    """The last ping of every (caid, window); windows close once the watermark passes them."""
    row = F.struct("local_timestamp", "ping_seq", "latitude", "longitude")
    windowed = pings.withWatermark("local_timestamp", late).groupBy("caid", F.window("local_timestamp", f"{seconds} seconds"))
    return windowed.agg(F.max_by(row, F.struct("local_timestamp", "ping_seq")).alias("p")).select("caid", "p.*")


def _metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * 1000 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


class _Day:
    """One user's running day; every field is in the state row."""

    def __init__(self, values: tuple) -> None:
        (self.day, self.last_us, self.last_seq, self.last_lat, self.last_lon, self.held_us, self.held_seq, self.held_m, self.held_kmh, self.trip, self.trips, self.stops, self.still) = values

    def values(self) -> tuple:
        return (self.day, self.last_us, self.last_seq, self.last_lat, self.last_lon, self.held_us, self.held_seq, self.held_m, self.held_kmh, self.trip, self.trips, self.stops, self.still)

    def release(self, caid: str, until_us: int | None) -> list[tuple]:
        """The held step's row, its time reaching to the next one that stays (0 at the day's end)."""
        if self.held_seq < 0:
            return []
        travel = 0.0 if until_us is None else (until_us - self.held_us) / 1e6
        if travel > TELEPORT_S:
            self.stops += 1
            self.trip, self.still = -self.stops, 0.0
        elif self.held_kmh < STOP_KMH and self.held_m < STILL_M:
            self.still += travel
            if self.still > STOP_S and self.trip >= 0:
                self.stops += 1
                self.trip = -self.stops
            elif self.trip == 0:
                self.trip = 1
        else:
            self.still = 0.0
            if self.trip <= 0:
                self.trips += 1
                self.trip = self.trips
        return [(caid, self.day, self.held_seq, self.held_m, self.held_kmh, travel, self.trip)]

    def arrive(self, caid: str, us: int, seq: int, lat: float, lon: float) -> list[tuple]:
        day, out = str(pd.Timestamp(us, unit="us").date()), []
        if self.last_seq >= 0 and us < self.last_us:
            return out  # late: neither the running day nor the held step may go back
        if day != self.day:
            out += self.release(caid, None)
            self.__init__(_EMPTY)
            self.day = day
        elif self.last_seq >= 0:
            seconds, metres = (us - self.last_us) / 1e6, _metres(self.last_lat, self.last_lon, lat, lon)
            speed = (metres / 1000) / (seconds / 3600) if seconds > 0 else 0.0
            if speed <= MAX_KMH:
                out += self.release(caid, self.last_us)
                self.held_us, self.held_seq, self.held_m, self.held_kmh = self.last_us, self.last_seq, metres, speed
        self.last_us, self.last_seq, self.last_lat, self.last_lon = us, seq, lat, lon
        return out


def segment_stream(pings: DataFrame, idle_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """Steps with trips of a stream of pings(caid, local_timestamp, ping_seq, latitude, longitude).

    A user's state is one row.  Each user-day's last step comes with the user's
    next day, or after ``idle_ms`` without pings.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (caid,) = key
        day, out = _Day(state.get if state.exists else _EMPTY), []
        if state.hasTimedOut:
            out = day.release(caid, None)
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(["us", "ping_seq"])
            for us, seq, lat, lon in rows[["us", "ping_seq", "latitude", "longitude"]].itertuples(index=False):
                out += day.arrive(caid, int(us), int(seq), lat, lon)
            state.update(day.values())
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=[x.split()[0] for x in OUTPUT.split(", ")])

    us = F.unix_micros(F.col("local_timestamp").cast("timestamp")).alias("us")
    rows = pings.select("caid", us, "ping_seq", "latitude", "longitude")
    return rows.groupBy("caid").applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
