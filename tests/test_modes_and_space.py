import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflux.operators import candidates, modes, proximity
from roadflux.operators.metro import metro_course
from roadflux.sources import fixtures as fx

ROW = "caid string, date date, id int, trip int, dis_lineal_m double, speed_kmh double, near_subway_line int, near_bus_route int"


def expected(rows):
    """numpy form of the classifier; rows of one user-day."""
    votes = {}
    for trip in {r[3] for r in rows if r[3] > 0}:
        own = [r for r in rows if r[3] == trip]
        km, avg = sum(r[4] for r in own) / 1000, np.mean([r[5] for r in own])
        total = np.zeros(4)
        for r in own:
            c = 0 if r[6] == 1 else 1 if r[7] == 1 else 2
            p = np.array(modes.NEARNESS[c]) * modes.SPEED[np.digitize(r[5], modes.SPEED_EDGES)] * modes.DISTANCE[np.digitize(km, modes.DISTANCE_EDGES)] * modes.AVERAGE[np.digitize(avg, modes.AVERAGE_EDGES)]
            total += p / (p.sum() or 1)
        votes[trip] = modes.MODES[int(np.argmax(np.round(total, 9)))]
    return {r[2]: votes[r[3]] if r[3] > 0 else "Parada" for r in rows}


def test_classifier_against_numpy(spark):
    rnd, rows, day = random.Random(1), [], dt.date(2024, 1, 1)
    for u in range(40):
        for i in range(rnd.randint(1, 30)):
            rows.append((f"u{u}", day, i, rnd.choice([-1, 1, 2, 3]), rnd.uniform(0, 3000), rnd.choice([0.0, 6.0, 6.001, 20.001, 80.001, 33.0]), rnd.randint(0, 1), rnd.randint(0, 1)))
    got = {(r.caid, r.id): r["mode"] for r in modes.classify(spark.createDataFrame(rows, ROW)).collect()}
    for u in {r[0] for r in rows}:
        for i, mode in expected([r for r in rows if r[0] == u]).items():
            assert got[u, i] == mode


def test_radius_join_equals_brute_force(spark):
    rnd = np.random.default_rng(2)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rnd.uniform(0, 3000, (300, 2)))]
    segs = [(i, 0, *map(float, rnd.uniform(0, 3000, 4))) for i in range(12)] + [(99, 0, 500.0, 500.0, 500.0, 500.0)]

    def away(p, s):
        a, b, q = np.array(s[2:4]), np.array(s[4:6]), np.array(p[1:])
        d = b - a
        t = 0 if not d.any() else min(1, max(0, (q - a) @ d / (d @ d)))
        return float(np.linalg.norm(a + t * d - q))

    pts = spark.createDataFrame(points, "id int, x double, y double")
    lines = spark.createDataFrame(segs, "line_id int, seq int, x1 double, y1 double, x2 double, y2 double")
    assert {r.id for r in proximity.within(pts, lines, ["id"], 100.0).collect()} == {p[0] for p in points if min(away(p, s) for s in segs) < 100}
    near = {r.id: (r.line_id, r.distance_m) for r in proximity.nearest_line(pts, lines, "id", cell=200.0).collect()}
    for p in points:
        d, line = min((away(p, s), s[0]) for s in segs)
        assert near[p[0]][0] == line and near[p[0]][1] == pytest.approx(d, abs=1e-6)


def test_nearest_line_has_no_distance_limit(spark):
    pts = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, 3e6), (3, 5e6, 0.0), (4, None, 0.0)], "id int, x double, y double")
    lines = spark.createDataFrame([(7, 0, 0.0, 0.0, 100.0, 0.0), (8, 0, 0.0, 1000.0, 100.0, 1000.0), (9, 0, 0.0, 1000.0, 100.0, 1000.0)], "line_id int, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {r.id: (r.line_id, r.distance_m) for r in proximity.nearest_line(pts, lines, "id").collect()}
    assert got == {1: (7, 10.0), 2: (8, 3e6 - 1000), 3: (7, 5e6 - 100), 4: (None, None)}
    assert {r.line_id for r in proximity.nearest_line(pts, lines.limit(0), "id").collect()} == {None}
    assert proximity.nearest_line(pts.where("id = 2"), lines, "id").first().line_id == 8


def test_nearest_edges_equal_brute_force(spark):
    rnd = np.random.default_rng(5)
    mids = [(int(i), int(i) + 1000, 0, float(x), float(y)) for i, (x, y) in enumerate(rnd.normal(0, 2000, (80, 2)))]
    pts = [(float(i), 0.0, float(x), float(y)) for i, (x, y) in enumerate(rnd.normal(0, 4000, (60, 2)))]
    got = candidates.nearest_edges(spark.createDataFrame(pts, "latitude double, longitude double, x double, y double"), spark.createDataFrame(mids, "u bigint, v bigint, key int, cx double, cy double"), 3, cell=150.0)
    for r in got.collect():
        x, y = pts[int(r.latitude)][2:]
        assert [e.u for e in r.edges] == [m[0] for m in sorted(mids, key=lambda m: (x - m[3]) ** 2 + (y - m[4]) ** 2)[:3]]
    assert got.count() == len(pts)


def test_nearest_edges_at_any_distance(spark):
    """Places far from every edge, and fewer edges than are asked for."""
    mids = [(i, i + 1, 0, 1000.0 * i, 0.0) for i in range(5)]
    pts = [(0.0, 0.0, 5.0, 5.0), (1.0, 1.0, 9e6, -7e6), (2.0, 2.0, -3e7, 1e7), (3.0, 3.0, None, 1.0)]
    frames = spark.createDataFrame(pts, "latitude double, longitude double, x double, y double"), spark.createDataFrame(mids, "u bigint, v bigint, key int, cx double, cy double")
    got = {r.latitude: [e.u for e in r.edges] for r in candidates.nearest_edges(*frames).collect()}
    assert got == {0.0: [0, 1, 2], 1.0: [4, 3, 2], 2.0: [0, 1, 2]}
    assert {r.latitude: len(r.edges) for r in candidates.nearest_edges(frames[0], frames[1].limit(2)).collect()} == {0.0: 2, 1.0: 2, 2.0: 2}
    assert candidates.nearest_edges(frames[0], frames[1].limit(0)).count() == 0


def test_cells_follow_the_course_of_a_long_line(spark):
    line = spark.createDataFrame([(1, 0, 0.0, 0.0, 100_000.0, 100_000.0)], "line_id int, seq int, x1 double, y1 double, x2 double, y2 double")
    cells = proximity._cells(line, 100.0).select("cx", "cy").collect()
    assert len(cells) == len(set(cells)) < 10_000 and {(i, i) for i in range(1000)} <= {tuple(c) for c in cells}


def test_percentiles_by_rank(spark):
    import numpy as np

    from roadflux.operators.ranks import percentiles

    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([0.0, 0.0, rnd.gauss(0, 9), None])) for _ in range(900)] + [("one", 5.0), ("none", None)]
    df, shares = spark.createDataFrame(rows, "g string, v double").repartition(5), [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.q for r in percentiles(df, "v", shares, ["g"]).collect()}
    for g in ("a", "b", None, "one"):
        assert got[g] == pytest.approx(np.percentile([v for x, v in rows if x == g and v is not None], [100 * x for x in shares]).tolist())
    assert "none" not in got and percentiles(df.limit(0), "v", shares).count() == 0
    assert percentiles(df, "v", [0.3]).first().q == pytest.approx([np.percentile([v for _, v in rows if v is not None], 30)])


def test_edge_geometry_moves_the_centroid(spark):
    nodes = spark.createDataFrame([("drive", 1, -100.0, 25.0), ("drive", 2, -99.99, 25.0)], "graph string, node bigint, lon double, lat double")
    edge = "graph string, u bigint, v bigint, key int, geometry string"
    rows = [("drive", 1, 2, 0, None), ("drive", 2, 1, 0, "LINESTRING (-99.99 25.0, -99.99 25.02, -100.0 25.02, -100.0 25.0)")]
    out = {r.u: r.cy for r in candidates.centroids(spark.createDataFrame(rows, edge), nodes).collect()}
    assert out[2] - out[1] > 1000


def test_metro_course(spark):
    segs = spark.createDataFrame([(0, 0, 0.0, 0.0, 100.0, 0.0), (0, 1, 100.0, 0.0, 100.0, 100.0), (1, 0, 0.0, 500.0, 100.0, 500.0)], "line_id int, seq int, x1 double, y1 double, x2 double, y2 double")
    trips = spark.createDataFrame([(7, 100.0, 100.0, 0.0, 5.0), (8, 10.0, 3.0, 10.0, 3.0)], "trip_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.trip_id, r.n): (round(r.x, 6), round(r.y, 6)) for r in metro_course(trips, segs, 5).collect()}
    assert [got[7, n] for n in range(5)] == [(100, 100), (100, 50), (100, 0), (50, 0), (0, 0)]
    assert {got[8, n] for n in range(5)} == {(10, 0)}


def test_flags_cover_both_sides(spark):
    rows = spark.createDataFrame([(25.6866, -100.3161), (25.6956, -100.2761)], "latitude double, longitude double")
    got = proximity.flag_infrastructure(rows, fx.lines(spark, fx.METRO_LINES), fx.lines(spark, fx.BUS_LINES))
    assert {(r.latitude, r.near_subway_line) for r in got.collect()} == {(25.6866, 1), (25.6956, 0)}
    assert got.select(F.max("near_bus_route")).first()[0] in (0, 1)
