import datetime as dt
import heapq
import random

import pytest
from pyspark.sql import functions as F

from roadflux.operators import paths, routing
from roadflux.operators.flatten import ROUTE_ORDER, route_table
from roadflux.sources import fixtures as fx

EDGE = "graph string, u bigint, v bigint, key int, length double, travel_time double, osmid string, highway string, geometry string"
T0 = dt.datetime(2024, 1, 10, 6)


def graph(spark, rows):
    return spark.createDataFrame([("drive", *r) for r in rows], EDGE)


def random_graph(rnd, nodes=14, roads=40):
    return [(rnd.randrange(nodes), rnd.randrange(nodes), 0, float(rnd.randint(1, 60)), None, None, None, None) for _ in range(roads)]


def lengths(rows, origin):
    near, queue = {}, [(0.0, origin)]
    while queue:
        d, n = heapq.heappop(queue)
        if n not in near:
            near[n] = d
            for u, v, _, size, *_ in rows:
                if u == n:
                    heapq.heappush(queue, (d + size, v))
    return near


def test_paths_and_their_join_form(spark):
    rows = random_graph(random.Random(4))
    edges = graph(spark, rows)
    pairs = spark.createDataFrame([("drive", u, v) for u in range(0, 14, 3) for v in range(14)], "graph string, u bigint, v bigint")
    want = {(u, v): d for u in range(0, 14, 3) for v, d in lengths(rows, u).items() if u != v}
    best = {}
    for u, v, _, size, *_ in rows:
        best[u, v] = min(size, best.get((u, v), 1e9))
    for limit in (1000, 1):  # 1: beyond the bound, by joins
        got = {(r.u, r.v): r.path for r in paths.shortest_paths(pairs, edges, max_edges=limit).collect()}
        assert set(got) == set(want)
        for (u, v), path in got.items():
            assert path[0] == u and path[-1] == v
            assert sum(best[a, b] for a, b in zip(path, path[1:], strict=False)) == pytest.approx(want[u, v])


@pytest.mark.parametrize("seed", [1, 2])
def test_both_forms_find_the_same_paths(spark, seed):
    """Edges of no length, equal lengths and unreachable goals: path by path the same."""
    rnd = random.Random(seed)
    rows = [(rnd.randrange(10), rnd.randrange(12), 0, rnd.choice([0.0, None, 1.0, 2.0]), None, None, None, None) for _ in range(26)]
    rows += [(9, 1, 0, 5.0, None, None, None, None), (9, 2, 0, 5.0, None, None, None, None), (1, 2, 0, None, None, None, None, None), (2, 1, 0, None, None, None, None, None)]
    edges = graph(spark, rows)
    pairs = spark.createDataFrame([("drive", u, v) for u in range(10) for v in range(13) if rnd.random() < 0.6], "graph string, u bigint, v bigint")
    one, other = ({(r.u, r.v): r.path for r in paths.shortest_paths(pairs, edges, max_edges=limit).collect()} for limit in (1000, 1))
    assert one == other and len(one) > 20
    with pytest.raises(RuntimeError):
        paths.relaxed_paths(pairs, paths.usable(edges), rounds=1)


def test_parallel_edges_and_missing_key_zero(spark):
    edges = graph(spark, [(1, 2, 0, 100.0, 10.0, None, None, None), (1, 2, 1, 50.0, None, None, None, None), (2, 3, 1, 10.0, 1.0, None, None, None)])
    pairs = spark.createDataFrame([("drive", 1, 2), ("drive", 1, 3), ("drive", 3, 1), ("drive", 2, 2)], "graph string, u bigint, v bigint")
    found = paths.shortest_paths(pairs, edges)
    assert {(r.u, r.v): r.path for r in found.collect()} == {(1, 2): [1, 2], (1, 3): [1, 2, 3]}
    # the length is read from the edge with key 0; a path without such an edge is no route
    assert {(r.u, r.v): (r.length_m, r.ideal_s) for r in paths.path_lengths(found, edges).collect()} == {(1, 2): (100.0, 10.0)}


def scan(day, far):
    """Choices of one user-day by the sequential definition; day: (trip, starts, ends, straight, seconds, limit)."""
    out, last_trip, last_node = [], None, None
    for trip, starts, ends, straight, seconds, limit in day:
        if trip != last_trip:
            last_node = None
        own = [last_node] if last_node is not None else starts
        last_trip, best = trip, None
        for u in own if trip > 0 else []:
            for v in ends:
                if u == v or v not in far[u]:
                    continue
                d = far[u][v]
                score = abs((d / straight if straight > 0 else 1.0) - 1)
                if best is None or score < best[0]:
                    best = (score, u, v, seconds > 0 and (d / 1000) / (seconds / 3600) > limit)
                if best[0] < 0.15:
                    break
            if best and best[0] < 0.15:
                break
        out.append(best[1:] if best else None)
        last_node = best[2] if best else None
    return out


def test_continuity_against_the_sequential_scan(spark):
    rnd = random.Random(9)
    roads = random_graph(rnd, 16, 45)
    far = {u: lengths(roads, u) for u in range(16)}
    rows, want = [], {}
    for n in range(60):
        nodes = [sorted(rnd.sample(range(16), rnd.randint(1, 4))) for _ in range(9)]
        trip, day = 1, []
        for i in range(8):
            trip = rnd.choice([trip, trip, trip, trip + 1, -1]) if trip > 0 else rnd.choice([trip, 5])
            day.append((trip, nodes[i], nodes[i + 1], rnd.choice([0.0, 5.0, 40.0, 90.0]), rnd.choice([0.0, 1.0, 3.0]), 100.0))
            rows.append((f"u{n}", T0.date(), i + 1, *day[-1][:1], "drive", *day[-1][1:]))
        want[f"u{n}"] = scan(day, far)
    legs = spark.createDataFrame(rows, "caid string, date date, row int, trip int, graph string, starts array<bigint>, ends array<bigint>, dis_lineal_m double, leg_s double, limit_kmh double")
    options, edges = routing.pairs(legs), graph(spark, [r for r in roads])
    known = paths.path_lengths(paths.shortest_paths(options.select("graph", "u", "v"), dedup(edges)), dedup(edges))
    got = {(r.caid, r.row): r for r in routing.continue_routes(legs, routing.scored_pairs(options, known)).collect()}
    for u, choices in want.items():
        for i, c in enumerate(choices):
            r = got[u, i + 1]
            assert (r.u, r.v) == (c[:2] if c else (None, None))
            if c:
                assert r.too_fast == c[2]


def dedup(edges):
    """Among parallel test edges the shortest, so lengths and attributes agree."""
    return edges.groupBy("graph", "u", "v").agg(F.min("length").alias("length")).select("graph", "u", "v", F.lit(0).alias("key"), "length", *[F.lit(None).cast(t).alias(c) for c, t in (("travel_time", "double"), ("osmid", "string"), ("highway", "string"), ("geometry", "string"))])


def steps(spark, rows):
    base = "caid string, date date, row int, i int, n int, leg_s double, limit_kmh double, too_fast boolean, ideal_s double, length double, travel_time double, local_timestamp timestamp_ntz"
    return spark.createDataFrame([("a", T0.date(), *r, T0) for r in rows], base)


@pytest.mark.parametrize(
    ("length", "fast", "limit", "want"),
    [
        (250.0, True, 100.0, (100.0, 100 / 3.6 * 10, False, True)),
        (250.1, True, 100.0, (0.0, 0.0, True, False)),
        (250.0, False, 100.0, (90.0, 250.0, False, False)),
        (250.0, False, 15.0, (15.0, 15 / 3.6 * 10, False, True)),
        (10.0, True, 100.0, (100.0, 100 / 3.6 * 10, False, True)),  # capped distance beyond the edge
    ],
)
def test_physics(spark, length, fast, limit, want):
    row = routing.correct(routing.allocate(steps(spark, [(1, 0, 1, 10.0, limit, fast, 0.0, length, None)]))).first()
    assert (row.speed_out, row.distance_m, row.failed, row.corrected) == pytest.approx(want)


def test_time_shares(spark):
    rows = [(1, 0, 2, 30.0, 150.0, False, 20.0, 100.0, 20.0), (1, 1, 2, 30.0, 150.0, False, 20.0, 100.0, None), (2, 0, 2, 30.0, 150.0, False, 0.0, 50.0, None), (2, 1, 2, 30.0, 150.0, False, 0.0, 50.0, None), (3, 0, 1, 0.0, 150.0, False, 1.0, 50.0, 1.0)]
    got = {(r.row, r.i): r for r in routing.with_clock(routing.allocate(steps(spark, rows))).collect()}
    assert got[1, 0].alloc_s == 30 and got[1, 1].alloc_s == pytest.approx(1.5)  # a missing time is 1 here, 0 in the sum
    assert got[2, 0].alloc_s == got[2, 1].alloc_s == 15 and got[3, 0].edge_kmh == 0
    assert got[1, 1].edge_time == T0 + dt.timedelta(seconds=30) and got[2, 1].edge_time == T0 + dt.timedelta(seconds=15)


def test_whole_chain_and_fallbacks(spark):
    nodes, edges = fx.lattice_nodes(spark), fx.lattice_edges(spark)
    row = "caid string, date date, ping_seq bigint, local_timestamp timestamp_ntz, latitude double, longitude double, trip int, mode string, dis_lineal_m double, nodes_drive array<bigint>, nodes_walk array<bigint>"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    day = T0.date()
    rows = [
        ("a", day, 0, at(0), 25.0, -100.0, 1, "Carro", 400.0, [0], [0]),
        ("a", day, 1, at(60), 25.0, -100.0, 1, "Carro", 400.0, [2], [2]),
        ("a", day, 2, at(120), 25.0, -100.0, -1, "Parada", 0.0, [4], [4]),
        ("a", day, 3, at(900), 25.0, -100.0, 2, "Caminar", 0.0, [4], [4]),
        ("a", day, 4, at(960), 25.0, -100.0, 2, "Caminar", 0.0, [4], [4]),
    ]
    out = routing.complete_routes(spark.createDataFrame(rows, row), edges, nodes)
    got = out.orderBy("row", "i").collect()
    assert [(r.row, r.start_node, r.end_node, r.highway) for r in got] == [
        (1, "0", "1", "unclassified"), (1, "1", "2", "residential"), (2, "2", "3", "primary"), (2, "3", "4", "residential"), (3, "4", "4", "parada_inactiva"), (4, "4", "4", "routing_error"),
    ]
    assert [r.failed for r in got] == [False] * 5 + [True]
    assert (got[4].latitude, got[4].longitude) == (25.0, -100.0) and got[4].geometry.startswith("POINT (-100.3091")
    old = routing.complete_routes(spark.createDataFrame(rows, row), edges, nodes, compat=True).where("highway = 'parada_inactiva'").first()
    assert (old.latitude, old.longitude) == (-100.0, 25.0)
    assert len(route_table(out).columns) == len(ROUTE_ORDER) == 15


def test_drawn_geometry_and_unknown_node(spark):
    nodes = spark.createDataFrame([("drive", 1, -100.0, 25.0), ("drive", 2, -100.1, 25.0)], "graph string, node bigint, lon double, lat double")
    edges = graph(spark, [(1, 2, 0, 100.0, 1.0, "7", "['a', 'b']", "LINESTRING (-100 25, -100.05 25.1, -100.1 25)")])
    row = "caid string, date date, ping_seq bigint, local_timestamp timestamp_ntz, latitude double, longitude double, trip int, mode string, dis_lineal_m double, nodes_drive array<bigint>, nodes_walk array<bigint>"
    day = [("a", T0.date(), i, T0 + dt.timedelta(seconds=60 * i), 25.0, -100.0, 1, "Carro", 100.0, [n], [n]) for i, n in enumerate((1, 2, 99))]
    got = routing.complete_routes(spark.createDataFrame(day, row), edges, nodes).orderBy("row").collect()
    assert got[0].geometry.count(",") == 2 and got[0].highway == "['a', 'b']" and got[0].osmid == "7"
    assert got[1].highway == "routing_error" and got[1].start_node == "2"
