import math

import pytest
from pyspark.sql import functions as F

from roadflux.functions import bins, clock, wkt
from roadflux.functions.geo import haversine_km, segment_distance, with_utm


def one(spark, sql, **columns):
    return spark.sql(f"select {sql}").select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    ("mph", "want"),
    [(0.0, 1), (2.4999, 1), (2.5, 2), (7.4999, 2), (7.5, 3), (72.4999, 15), (72.5, 16), (500.0, 16), (-1.0, 1), (None, 1), (math.inf, 1), (math.nan, 1)],
)
def test_speed_bin(spark, mph, want):
    df = spark.createDataFrame([(mph,)], "x double")
    assert df.select(bins.speed_bin(F.col("x"))).first()[0] == want


@pytest.mark.parametrize(("value", "want"), [(6.0, 0), (6.001, 1), (20.0, 1), (20.001, 2), (80.0, 2), (80.001, 3), (math.nan, 3), (None, 3)])
def test_digitize(spark, value, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(bins.digitize(F.col("x"), [6.001, 20.001, 80.001])).first()[0] == want


@pytest.mark.parametrize(
    ("trip", "mode", "want"), [(1, "Carro", 21), (1, "Autobus", 21), (1, "MICROBUS", 42), (1, "Metro", 0), (-1, "Carro", 0), (1, None, 0), (1, "Caminar", 0)]
)
def test_source(spark, trip, mode, want):
    df = spark.createDataFrame([(trip, mode)], "t int, m string")
    assert df.select(bins.source_id(F.col("t"), F.col("m"))).first()[0] == want


def test_haversine(spark):
    row = one(spark, "1", d=haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)), zero=haversine_km(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(5.0)), far=haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert row.d == pytest.approx(6371 * math.pi / 2) and row.zero == 0 and row.far == pytest.approx(6371 * math.pi)


def test_utm_on_the_central_meridian(spark):
    row = with_utm(spark.sql("select 45.0D lat, -99.0D lon"), "lat", "lon", "x", "y").first()
    assert row.x == pytest.approx(500000, abs=1e-6) and row.y == pytest.approx(4982950.400, abs=0.01)


def test_utm_agrees_with_the_sphere_within_half_a_percent(spark):
    df = with_utm(with_utm(spark.sql("select 25.68D a, -100.31D b, 25.70D c, -100.30D d"), "a", "b", "x1", "y1"), "c", "d", "x2", "y2")
    row = df.select(F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2).alias("m"), (haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")) * 1000).alias("h")).first()
    assert abs(row.m / row.h - 1) < 0.005


@pytest.mark.parametrize(("p", "want"), [((5, 3), 3.0), ((-4, 3), 5.0), ((13, 4), 5.0), ((10, 0), 0.0)])
def test_segment_distance(spark, p, want):
    args = [F.lit(float(v)) for v in (*p, 0, 0, 10, 0)]
    assert one(spark, "1", d=segment_distance(*args)).d == pytest.approx(want)
    assert one(spark, "1", d=segment_distance(F.lit(3.0), F.lit(4.0), *[F.lit(0.0)] * 4)).d == 5  # no length


def test_wkt(spark):
    row = one(spark, "1", p=wkt.points(F.lit("LINESTRING (-100.3 25.6, -1e2 2.57E1)")), q=wkt.points(wkt.point(F.lit(-100.5), F.lit(25.25))))
    assert [(x.lon, x.lat) for x in row.p] == [(-100.3, 25.6), (-100.0, 25.7)]
    assert [(x.lon, x.lat) for x in row.q] == [(-100.5, 25.25)]
    assert one(spark, "1", p=wkt.parts(F.lit("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))"))).p == ["0 0, 1 1", "2 2, 3 3"]


@pytest.mark.parametrize(
    ("kind", "value", "want"),
    [("bigint", 1667111400, "2022-10-30 06:30:00"), ("double", 1667111400.25, "2022-10-30 06:30:00.25"), ("string", "2022-10-30 06:30:00", "2022-10-30 06:30:00"), ("string", "soon", None), ("bigint", None, None)],
)
def test_time_sources(spark, kind, value, want):
    df = spark.createDataFrame([(value,)], f"t {kind}")
    assert df.select(clock.utc_instant(df, "t").cast("string")).first()[0] == want


def test_epoch_milliseconds_are_refused(spark):
    df = spark.createDataFrame([(1667111400000,)], "t bigint")
    with pytest.raises(Exception, match="epoch seconds"):
        df.select(clock.utc_instant(df, "t")).collect()


def test_local_time_follows_the_october_change_of_2022(spark):
    df = spark.sql("select timestamp_ntz'2022-10-30 06:30:00' a, timestamp_ntz'2022-10-30 07:30:00' b, timestamp_ntz'2023-07-01 12:00:00' c, timestamp_ntz'2022-07-01 12:00:00' d")
    row = df.select(*[clock.to_local(F.col(c)).cast("string").alias(c) for c in "abcd"]).first()
    assert tuple(row) == ("2022-10-30 01:30:00", "2022-10-30 01:30:00", "2023-07-01 06:00:00", "2022-07-01 07:00:00")


def test_day_type_and_hour(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05 23:59:59' fri, timestamp_ntz'2024-01-06 00:00:00' sat")
    row = df.select(bins.day_type(F.col("fri")).alias("a"), bins.day_type(F.col("sat")).alias("b"), bins.hour_1_to_24(F.col("fri")).alias("c"), bins.hour_1_to_24(F.col("sat")).alias("d")).first()
    assert tuple(row) == (5, 2, 24, 1)
