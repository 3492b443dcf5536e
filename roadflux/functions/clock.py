"""Time expressions; all times inside the engine are naive (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Monterrey"
MAX_EPOCH_SECONDS = 32503680000  # year 3000: larger numbers are not seconds


def utc_instant(df: DataFrame, column: str) -> Column:
    """Naive UTC time of epoch seconds, text, a zoned timestamp or a naive timestamp.

    Numbers that cannot be epoch seconds (milliseconds, say) raise instead of
    becoming another date.
    """
    kind, col = dict(df.dtypes)[column], F.col(column)
    if kind == "timestamp_ntz":
        return col
    if kind == "timestamp":
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))
    if kind in ("string", "date"):
        return F.expr(f"try_cast(`{column}` AS timestamp_ntz)") if kind == "string" else col.cast("timestamp_ntz")
    ok = F.abs(col) <= MAX_EPOCH_SECONDS
    checked = F.when(col.isNull() | ok, col).otherwise(F.raise_error(F.lit(f"{column} is not in epoch seconds")).cast("double"))
    micros = F.round(checked.cast("double") * 1_000_000).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_local(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def micros(ts: Column) -> Column:
    """Microseconds of a naive time since 1970."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fractions."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.round(seconds * 1e6).cast("bigint"), ts)


def bucket(ts: Column, seconds: int) -> Column:
    """Number of the epoch-aligned window that a time falls into."""
    return F.floor(micros(ts) / (seconds * 1_000_000))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
