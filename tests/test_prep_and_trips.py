import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadflux.operators import prep, trips

T0 = dt.datetime(2024, 1, 10, 6)
PING = "caid string, ping_seq bigint, local_timestamp timestamp_ntz, latitude double, longitude double"
STEP = "caid string, date date, ping_seq bigint, local_timestamp timestamp_ntz, travel_s double, speed_kmh double, dis_lineal_m double"


def model(rows):
    """Trips of one user-day by the sequential definition; rows of (travel_s, speed, metres)."""
    out, trip_no, stop_no, still = [], 0, 0, 0.0
    for tt, speed, metres in ((a or 0, b or 0, c or 0) for a, b, c in rows):
        before = out[-1] if out else None
        if tt > 1800:
            stop_no, still = stop_no + 1, 0.0
            out.append(-stop_no)
        elif speed < 3 and metres < 100:
            still += tt
            if still <= 300:
                out.append(1 if before is None else before)
            elif before is None or before > 0:
                stop_no += 1
                out.append(-stop_no)
            else:
                out.append(before)
        else:
            still = 0.0
            if before is None or before < 0:
                trip_no += 1
                out.append(trip_no)
            else:
                out.append(before)
    return out


def days(spark, cases):
    rows = []
    for n, case in enumerate(cases):
        for i, (tt, speed, metres) in enumerate(case):
            rows.append((f"u{n}", T0.date(), i, T0 + dt.timedelta(seconds=i), tt, speed, metres))
    return spark.createDataFrame(rows, STEP)


GOLDEN = [
    [(1800.0, 50.0, 500.0), (1801.0, 50.0, 500.0), (10.0, 50.0, 500.0)],
    [(300.0, 0.0, 0.0), (1.0, 0.0, 0.0), (10.0, 3.0, 0.0)],
    [(10.0, 2.999, 99.9), (10.0, 2.999, 100.0), (10.0, 3.0, 99.9)],
    [(301.0, 0.0, 0.0), (10.0, 9.0, 0.0), (200.0, 0.0, 0.0), (101.0, 0.0, 0.0), (5.0, 30.0, 300.0)],
    [(10.0, 0.0, 0.0), (10.0, 0.0, 0.0), (400.0, 0.0, 0.0), (10.0, 40.0, 400.0)],
    [(None, None, None), (400.0, None, None)],
    [(1801.0, 0.0, 0.0), (1801.0, 0.0, 0.0), (400.0, 0.0, 0.0)],
]


def test_trips_golden_and_random(spark):
    rnd = random.Random(7)
    cases = GOLDEN + [[(rnd.choice([5.0, 100.0, 250.0, 300.0, 301.0, 1800.0, 1801.0]), rnd.choice([0.0, 2.9, 3.0, 40.0]), rnd.choice([0.0, 99.0, 100.0])) for _ in range(rnd.randint(1, 25))] for _ in range(300)]
    got = {}
    for r in trips.assign_trips(days(spark, cases)).collect():
        got.setdefault(r.caid, {})[r.ping_seq] = r.trip
    for n, case in enumerate(cases):
        assert [got[f"u{n}"][i] for i in range(len(case))] == model(case), case


def test_one_exchange_and_no_python(spark):
    plan = trips.assign_trips(days(spark, GOLDEN))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Pandas" not in plan


def pings(spark, rows):
    return spark.createDataFrame([(c, i, T0 + dt.timedelta(seconds=s), la, lo) for i, (c, s, la, lo) in enumerate(rows)], PING)


def test_downsample_keeps_the_last_of_each_window(spark):
    df = pings(spark, [("a", 0, 1.0, 1.0), ("a", 9.999, 2.0, 2.0), ("a", 10, 3.0, 3.0), ("a", 10, 4.0, 4.0), ("b", 5, 5.0, 5.0)])
    assert sorted(r.ping_seq for r in prep.downsample(df).collect()) == [1, 3, 4]
    assert prep.downsample(df).columns == df.columns


def test_sparse_ids_and_sample(spark):
    df = pings(spark, [("a", i, 1.0, 1.0) for i in range(3)] + [("b", i, 1.0, 1.0) for i in range(2)] + [("c", 0, 1.0, 1.0)])
    assert {r.caid for r in prep.drop_sparse_ids(df).collect()} == {"a"}
    assert {r.caid for r in prep.sample_users(df, 2).collect()} == {"a", "b"}
    assert prep.sample_users(df, None).count() == 6


@pytest.mark.parametrize(("offsets", "left"), [([0, 1], [0, 1]), ([0, 1, 2], [1]), ([0, 0], [0, 0])])
def test_whole_days(spark, offsets, left):
    df = pings(spark, [("a", 86400 * d, 1.0, 1.0) for d in offsets])
    first = T0.date()
    assert sorted((r.date - first).days for r in prep.whole_days(df).collect()) == left


def test_fence_is_strict(spark):
    df = pings(spark, [("a", 0, prep.CENTRE_LAT, prep.CENTRE_LON), ("a", 1, prep.CENTRE_LAT + 1, prep.CENTRE_LON), ("a", 2, None, 1.0)])
    assert [r.ping_seq for r in prep.geofence(df).collect()] == [0]


def test_vectors_and_travel_times(spark):
    df = pings(spark, [("a", 0, 25.0, -100.0), ("a", 60, 25.001, -100.0), ("a", 61, 25.1, -100.0), ("a", 121, 25.1, -100.0)]).withColumn("date", F.to_date("local_timestamp"))
    rows = {r.ping_seq: r for r in prep.travel_times(prep.vectors(df)).collect()}
    assert set(rows) == {0, 2}  # 1 is too fast, 3 has no next ping
    assert rows[0].travel_s == 61 and rows[2].travel_s == 0 and rows[0].dis_lineal_m == pytest.approx(111.19, abs=0.01)
    assert rows[2].speed_kmh == 0


def test_gaps_across_days_equal_a_plain_lag(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.randrange(0, 5 * 86400), 1.0, 1.0) for _ in range(200)]
    df = pings(spark, rows).withColumnRenamed("local_timestamp", "utc_timestamp")
    got = sorted((r.caid, r.ping_seq, r.gap_s) for r in prep.gaps(df).collect())
    want = []
    for c in "ab":
        own = sorted((s, i) for i, (k, s, *_) in enumerate(rows) if k == c)
        want += [(c, i, float(s - p)) for (p, _), (s, i) in zip(own, own[1:], strict=False)]
    assert got == sorted(want)


def test_empty_input(spark):
    df = pings(spark, [("a", 0, 1.0, 1.0)]).where("false").withColumnRenamed("local_timestamp", "utc_timestamp")
    assert trips.assign_trips(prep.prepare(df)).count() == 0
