"""DuckDB SQL for the registered queries, written from the definitions and composed of CTEs."""

from __future__ import annotations

import math

from roadflux.sources.fixtures import BUS_LINES, METRO_LINES

P = ["CO", "CO2", "CO2_Equiv", "HC", "NOx", "PM10", "PM25"]


def hav(a: str, b: str, c: str, d: str) -> str:
    """Kilometres between (a, b) and (c, d), degrees."""
    s = f"(pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))"
    return f"(12742e0 * atan2(sqrt({s}), sqrt(greatest(1 - {s}, 0))))"


def raw(caid: str = "user_id % 4") -> str:
    return f"""raw AS (SELECT CAST({caid} AS VARCHAR) AS caid, event_id AS ping_seq, CAST(ts AS TIMESTAMP) AS utc,
      25.6866e0 + floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 34) * 0.01e0 AS lat,
      -100.3161e0 + CASE WHEN value > 250 THEN 0.6e0 ELSE floor(value / 50) * 0.01e0 END AS lon FROM events),
    loc AS (SELECT *, (utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/Monterrey' AS lt FROM raw)"""


THIN = "thin AS (SELECT * FROM loc QUALIFY row_number() OVER (PARTITION BY caid, epoch_us(lt) // 10000000 ORDER BY lt DESC, ping_seq DESC) = 1)"
FENCE = f"fence AS (SELECT *, {hav('25.6866e0', '-100.3161e0', 'lat', 'lon')} AS km FROM thin WHERE {hav('25.6866e0', '-100.3161e0', 'lat', 'lon')} < 48)"
DENSE = "dense AS (SELECT * FROM fence QUALIFY count(*) OVER (PARTITION BY caid) > 2)"
DAYS = """dated AS (SELECT *, CAST(lt AS DATE) AS day FROM dense),
    span AS (SELECT count(DISTINCT day) AS n, min(day) AS lo, max(day) AS hi FROM dated),
    days AS (SELECT dated.* FROM dated, span WHERE n < 3 OR (day > lo AND day < hi))"""
VEC = f"""ahead AS (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, lead(lt) OVER w AS lt2 FROM days WINDOW w AS (PARTITION BY caid, day ORDER BY lt, ping_seq)),
    moved AS (SELECT *, {hav('lat', 'lon', 'lat2', 'lon2')} * 1000 AS m, (epoch_us(lt2) - epoch_us(lt)) / 1e6 AS s FROM ahead WHERE lt2 IS NOT NULL),
    vec AS (SELECT * FROM (SELECT *, CASE WHEN s > 0 THEN (m / 1000) / (s / 3600) ELSE 0 END AS kmh FROM moved) WHERE kmh <= 150),
    steps AS (SELECT *, coalesce((epoch_us(lead(lt) OVER w) - epoch_us(lt)) / 1e6, 0) AS tt, row_number() OVER w AS n FROM vec WINDOW w AS (PARTITION BY caid, day ORDER BY lt, ping_seq))"""
PREP = ", ".join([raw(), THIN, FENCE, DENSE, DAYS, VEC])
# the segmenter as the state machine that it is: one recursion step a row
TRIPS = """walk AS (
      SELECT DISTINCT caid, day, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS ping_seq, CAST(NULL AS INTEGER) AS trip, 0 AS trips, 0 AS stops, CAST(0 AS DOUBLE) AS acc FROM steps
      UNION ALL
      SELECT caid, day, n, ping_seq,
        CASE WHEN kind = 'T' OR opens_stop THEN -(stops + 1) WHEN opens_trip THEN trips + 1 ELSE coalesce(trip, 1) END,
        trips + CASE WHEN opens_trip THEN 1 ELSE 0 END, stops + CASE WHEN kind = 'T' OR opens_stop THEN 1 ELSE 0 END, acc
      FROM (SELECT x.*, kind = 'S' AND acc > 300 AND (trip IS NULL OR trip > 0) AS opens_stop, kind = 'M' AND (trip IS NULL OR trip < 0) AS opens_trip
            FROM (SELECT s.caid, s.day, s.n, s.ping_seq, w.trip, w.trips, w.stops, k.kind, CASE WHEN k.kind = 'S' THEN w.acc + s.tt ELSE 0 END AS acc
                  FROM walk w JOIN steps s ON s.caid = w.caid AND s.day = w.day AND s.n = w.n + 1
                  JOIN (SELECT caid, day, n, CASE WHEN tt > 1800 THEN 'T' WHEN kmh < 3 AND m < 100 THEN 'S' ELSE 'M' END AS kind FROM steps) k ON k.caid = s.caid AND k.day = s.day AND k.n = s.n) x)),
    seg AS (SELECT steps.*, walk.trip FROM steps JOIN walk USING (caid, day, n))"""

_N = (1 / 298.257223563) / (2 - 1 / 298.257223563)
_R = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * 0.9996
_AL = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_E = 2 * math.sqrt(_N) / (1 + _N)


def utm(name: str, source: str, lat: str = "lat", lon: str = "lon", x: str = "x", y: str = "y") -> str:
    """CTE ``name``: source with planar x and y."""
    east = " + ".join(f"{a!r} * cos({2 * j} * xi_) * sinh({2 * j} * eta_)" for j, a in enumerate(_AL, 1))
    north = " + ".join(f"{a!r} * sin({2 * j} * xi_) * cosh({2 * j} * eta_)" for j, a in enumerate(_AL, 1))
    return f"""{name} AS (SELECT * EXCLUDE (s_, l_, t_, xi_, eta_), 500000e0 + {_R!r} * (eta_ + {east}) AS {x}, {_R!r} * (xi_ + {north}) AS {y}
      FROM (SELECT *, atan2(t_, cos(l_)) AS xi_, atanh(sin(l_) / sqrt(1 + t_ * t_)) AS eta_
        FROM (SELECT *, sinh(atanh(s_) - {_E!r} * atanh({_E!r} * s_)) AS t_
          FROM (SELECT *, sin(radians({lat})) AS s_, radians({lon} + 99e0) AS l_ FROM {source}))))"""


def line_table(name: str, texts: list[str]) -> str:
    rows = []
    for i, text in enumerate(texts):
        xy = [p.split() for p in text[text.index("(") + 1 : -1].split(", ")]
        rows += [f"({i}, {a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for a, b in zip(xy, xy[1:], strict=False)]
    values = f"{name}0 AS (SELECT * FROM (VALUES {', '.join(rows)}) AS t(line_id, lon1, lat1, lon2, lat2))"
    return ", ".join([values, utm(f"{name}1", f"{name}0", "lat1", "lon1", "x1", "y1"), utm(name, f"{name}1", "lat2", "lon2", "x2", "y2")])


def distance(lines: str) -> str:
    """CTE d_<lines>: every place's distance to every line piece."""
    t = "greatest(0, least(1, coalesce(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0)))"
    return f"""d_{lines} AS (SELECT lat, lon, line_id, sqrt((x1 + t * (x2 - x1) - x) * (x1 + t * (x2 - x1) - x) + (y1 + t * (y2 - y1) - y) * (y1 + t * (y2 - y1) - y)) AS d
      FROM (SELECT *, {t} AS t FROM places, {lines}))"""


PLACES = utm("places", "(SELECT DISTINCT lat, lon FROM fence)")
NEAR = ", ".join([PLACES, line_table("metro", METRO_LINES), line_table("bus", BUS_LINES), distance("metro"), distance("bus")])
FLAGS = """flagged AS (SELECT seg.*, CAST(coalesce(a.d < 100, false) AS INTEGER) AS near_subway_line, CAST(coalesce(b.d < 100, false) AS INTEGER) AS near_bus_route FROM seg
      LEFT JOIN (SELECT lat, lon, min(d) AS d FROM d_metro GROUP BY ALL) a USING (lat, lon) LEFT JOIN (SELECT lat, lon, min(d) AS d FROM d_bus GROUP BY ALL) b USING (lat, lon))"""

MODE = """tripped AS (SELECT *, CASE WHEN near_subway_line = 1 THEN 0 WHEN near_bus_route = 1 THEN 1 ELSE 2 END AS c,
        CASE WHEN kmh < 6.001e0 THEN 0 WHEN kmh < 20.001e0 THEN 1 WHEN kmh < 80.001e0 THEN 2 ELSE 3 END AS v,
        sum(m) OVER w / 1000 AS km_all, avg(kmh) OVER w AS kmh_all FROM flagged WHERE trip > 0 WINDOW w AS (PARTITION BY caid, day, trip)),
    bins AS (SELECT *, CASE WHEN km_all < 1 THEN 0 WHEN km_all < 6.001e0 THEN 1 WHEN km_all < 10.001e0 THEN 2 WHEN km_all < 18.001e0 THEN 3 ELSE 4 END AS d,
        CASE WHEN kmh_all < 6.001e0 THEN 0 ELSE 1 END AS a FROM tripped),
    t_c(c, c0, c1, c2, c3) AS (VALUES (0, .1e0, .1e0, .8e0, 0e0), (1, .1e0, .8e0, 0e0, .1e0), (2, .4e0, .25e0, .05e0, .3e0)),
    t_v(v, v0, v1, v2, v3) AS (VALUES (0, .05e0, .1e0, .15e0, .6e0), (1, .47e0, .38e0, .05e0, .1e0), (2, .5e0, .3e0, .2e0, 0e0), (3, 1e0, 0e0, 0e0, 0e0)),
    t_d(d, d0, d1, d2, d3) AS (VALUES (0, .1e0, .2e0, .3e0, .4e0), (1, .25e0, .25e0, .3e0, .2e0), (2, .4e0, .15e0, .25e0, .2e0), (3, .6e0, .3e0, 0e0, .1e0), (4, .4e0, .4e0, 0e0, .2e0)),
    t_a(a, a0, a1, a2, a3) AS (VALUES (0, .1e0, .1e0, .2e0, .6e0), (1, .4e0, .25e0, .25e0, .1e0)),
    prob AS (SELECT caid, day, trip, c0*v0*d0*a0 AS p0, c1*v1*d1*a1 AS p1, c2*v2*d2*a2 AS p2, c3*v3*d3*a3 AS p3 FROM bins JOIN t_c USING (c) JOIN t_v USING (v) JOIN t_d USING (d) JOIN t_a USING (a)),
    votes AS (SELECT caid, day, trip, round(sum(p0/s), 9) AS s0, round(sum(p1/s), 9) AS s1, round(sum(p2/s), 9) AS s2, round(sum(p3/s), 9) AS s3 FROM (SELECT *, p0+p1+p2+p3 AS s FROM prob) GROUP BY ALL),
    best AS (SELECT caid, day, trip, ['Carro', 'Bus', 'Metro', 'Caminar'][list_position([s0, s1, s2, s3], greatest(s0, s1, s2, s3))] AS mode FROM votes)"""

LATTICE = """ij AS (SELECT range AS node, range // 22 AS i, range % 22 AS j FROM range(264)),
    nodes AS (SELECT graph, node, -100.3171e0 + j * 0.002e0 AS lon, 25.6856e0 + i * 0.002e0 AS lat FROM ij, (VALUES ('drive'), ('walk')) g(graph)),
    links AS (SELECT a.node AS u, b.node AS v, CASE WHEN a.i <> b.i THEN 222.4e0 ELSE 200.4e0 END * (1 + ((37*a.i + 61*a.j + 17*b.i + 29*b.j) % 97) / 97e0 * 0.25e0) AS length
              FROM ij a JOIN ij b ON abs(a.i - b.i) + abs(a.j - b.j) = 1),
    edges AS (SELECT graph, u, v, length, CASE WHEN (u + v) % 19 <> 0 THEN length / 8.33e0 END AS travel_time FROM links, (VALUES ('drive'), ('walk')) g(graph)
              WHERE graph = 'drive' OR (u * 7 + v) % 23 <> 0)"""
KNN = ", ".join(
    [
        utm("spots", "(SELECT * FROM nodes WHERE graph = 'drive')"),
        """mid AS (SELECT e.u, e.v, (a.x + b.x) / 2 AS cx, (a.y + b.y) / 2 AS cy FROM edges e JOIN spots a ON a.node = e.u JOIN spots b ON b.node = e.v WHERE e.graph = 'drive')""",
        """near3 AS (SELECT lat, lon, u, v FROM places, mid QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY pow(x - cx, 2) + pow(y - cy, 2), u, v) <= 3)""",
        """cand AS (SELECT lat, lon, list_sort(list_distinct(flatten(list([u, v])))) AS nodes FROM near3 GROUP BY ALL)""",
    ]
)
KEYED_DISTANCES = """dist(graph, src, node, far) USING KEY (graph, src, node) AS (
      SELECT graph, u AS src, u AS node, CAST(0 AS DOUBLE) AS far FROM (SELECT DISTINCT graph, u FROM origin)
      UNION
      SELECT d.graph, d.src, e.v, min(d.far + e.length) FROM dist d JOIN edges e ON e.graph = d.graph AND e.u = d.node
        LEFT JOIN recurring.dist k ON k.graph = d.graph AND k.src = d.src AND k.node = e.v
      WHERE k.far IS NULL OR d.far + e.length < k.far GROUP BY ALL)"""
LEGS = """ranked AS (SELECT seg.*, row_number() OVER w AS row, lead(lt) OVER w AS lt_next, lead(lat) OVER w AS lat_next, lead(lon) OVER w AS lon_next FROM seg WINDOW w AS (PARTITION BY caid, day ORDER BY lt, ping_seq)),
    legs AS (SELECT r.*, a.nodes AS starts, b.nodes AS ends, (epoch_us(lt_next) - epoch_us(lt)) / 1e6 AS leg_s FROM ranked r
      LEFT JOIN cand a ON a.lat = r.lat AND a.lon = r.lon LEFT JOIN cand b ON b.lat = r.lat_next AND b.lon = r.lon_next WHERE lt_next IS NOT NULL)"""
PAIRS = """od AS (SELECT caid, day, row, m, leg_s, u, i, unnest(ends) AS v, generate_subscripts(ends, 1) AS j FROM (SELECT *, unnest(starts) AS u, generate_subscripts(starts, 1) AS i FROM legs WHERE trip > 0)),
    origin AS (SELECT DISTINCT 'drive' AS graph, u FROM od)"""
SCORED = """sc AS (SELECT od.*, far, abs(CASE WHEN m > 0 THEN far / m ELSE 1 END - 1) AS score, CASE WHEN leg_s > 0 THEN (far / 1000) / (leg_s / 3600) ELSE 0 END > 150 AS too_fast FROM od JOIN dist ON src = u AND node = v WHERE u <> v)"""
# the day's fold: a leg of the same trip starts where the leg before ended
FOLD = """fold AS (
      SELECT DISTINCT caid, day, CAST(0 AS BIGINT) AS row, CAST(NULL AS INTEGER) AS trip, CAST(NULL AS BIGINT) AS node, CAST(NULL AS STRUCT(u BIGINT, v BIGINT, f BOOLEAN)) AS b, CAST(NULL AS BIGINT) AS start FROM legs
      UNION ALL
      SELECT caid, day, row, trip, b.v, b, coalesce(held, first) FROM (
        SELECT x.*, (SELECT min_by(struct_pack(u := u, v := v, f := too_fast), struct_pack(late := score >= 0.15, s := CASE WHEN score < 0.15 THEN 0 ELSE score END, i := i, j := j))
                     FROM sc WHERE sc.caid = x.caid AND sc.day = x.day AND sc.row = x.row AND (x.held IS NULL OR sc.u = x.held)) AS b
        FROM (SELECT l.caid, l.day, l.row, l.trip, starts[1] AS first, CASE WHEN l.trip = f.trip THEN f.node END AS held FROM fold f JOIN legs l ON l.caid = f.caid AND l.day = f.day AND l.row = f.row + 1) x))"""

SEG = """segs AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS caid, l_linenumber * CASE WHEN l_returnflag = 'N' AND l_linenumber >= 6 THEN -1 ELSE 1 END AS trip,
      CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS lt, l_quantity * 3 - 3 AS kmh, l_extendedprice / 100 AS m,
      ['Carro', 'Bus', 'Metro', 'Caminar'][1 + l_partkey % 4] AS mode,
      ['motorway', 'primary', 'secondary', 'residential', 'living_street', 'routing_error', 'parada_inactiva', 'trunk_link'][1 + l_suppkey % 8] AS highway,
      l_discount >= 0.09e0 AS failed, l_tax >= 0.07e0 AS corrected FROM lineitem)"""
FEAT = """feat AS (SELECT *, CAST(month(lt) AS INTEGER) AS "Month", CAST(hour(lt) + 1 AS INTEGER) AS "Hour", CASE WHEN isodow(lt) <= 5 THEN 5 ELSE 2 END AS "Day",
      CASE WHEN highway IN ('motorway', 'motorway_link', 'trunk', 'trunk_link', 'primary', 'primary_link') THEN 4 ELSE 5 END AS "Road",
      CASE WHEN trip < 0 THEN 0 WHEN mode ILIKE '%carro%' OR mode ILIKE '%auto%' THEN 21 WHEN mode ILIKE '%bus%' THEN 42 ELSE 0 END AS "Source", kmh * 0.621371e0 AS mph FROM segs),
    feats AS (SELECT *, CASE WHEN mph < 2.5 THEN 1 ELSE (SELECT CAST(max(b) AS INTEGER) FROM (VALUES (1, 0e0), (2, 2.5e0), (3, 7.5e0), (4, 12.5e0), (5, 17.5e0), (6, 22.5e0), (7, 27.5e0), (8, 32.5e0),
      (9, 37.5e0), (10, 42.5e0), (11, 47.5e0), (12, 52.5e0), (13, 57.5e0), (14, 62.5e0), (15, 67.5e0), (16, 72.5e0)) AS e(b, lo) WHERE lo <= mph) END AS "SpeedBin" FROM feat)"""
RATES = """ri AS (SELECT CAST(range AS INTEGER) AS i FROM range(3072)),
    r0 AS (SELECT i, CASE WHEN (i // 1536) % 2 = 0 THEN 5 ELSE 2 END AS "Day", CAST(1 + (i // 64) % 24 AS INTEGER) AS "Hour", CAST(4 + (i // 32) % 2 AS INTEGER) AS "Road",
      CASE WHEN (i // 16) % 2 = 0 THEN 21 ELSE 42 END AS "Source", 1 + i % 16 AS "SpeedBin",
      1 + (i * 37 % 101) / 10e0 AS "CO", 100 + (i * 41 % 197) / 2e0 AS "CO2", CASE WHEN i % 13 <> 0 THEN 110 + (i * 43 % 199) / 2e0 END AS "CO2_Equiv", (i * 47 % 83) / 100e0 + 0.01e0 AS "HC",
      CASE WHEN i % 11 <> 0 THEN 2 + (i * 53 % 89) / 100e0 END AS "NOx", (i * 59 % 71) / 1000e0 + 0.001e0 AS "PM10", CASE WHEN i % 17 <> 0 THEN (i * 61 % 67) / 1000e0 + 0.001e0 END AS "PM25" FROM ri),
    r1 AS (SELECT * FROM r0 WHERE i % 7 <> 3 AND NOT ("Source" = 42 AND "SpeedBin" >= 15)),
    r2 AS (SELECT * FROM r1 UNION ALL SELECT * REPLACE ("CO" + 0.5e0 AS "CO") FROM r1 WHERE i % 5 = 0),
    means AS (SELECT "Day", "Hour", "Road", "Source", "SpeedBin", """ + ", ".join(f'avg("{p}") AS "{p}"' for p in P) + """ FROM r2 GROUP BY ALL)"""
CURVE = (
    'bybin AS (SELECT "Source", "SpeedBin", ' + ", ".join(f'avg("{p}") AS "{p}"' for p in P) + ' FROM means GROUP BY ALL), '
    'grid AS (SELECT * FROM (SELECT DISTINCT "Source" FROM means), (SELECT CAST(range AS INTEGER) AS "SpeedBin" FROM range(1, 17))), '
    'curve AS (SELECT "Source", "SpeedBin", '
    + ", ".join(f'coalesce(last_value("{p}" IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value("{p}" IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS "{p}"' for p in P)
    + ' FROM grid LEFT JOIN bybin USING ("Source", "SpeedBin") WINDOW w AS (PARTITION BY "Source" ORDER BY "SpeedBin"))'
)
JOIN = 'exact AS (SELECT f.*, ' + ", ".join(f'r."{p}"' for p in P) + ' FROM feats f LEFT JOIN means r ON f."Source" > 0 AND f."Day" = r."Day" AND f."Hour" = r."Hour" AND f."Road" = r."Road" AND f."Source" = r."Source" AND f."SpeedBin" = r."SpeedBin")'
FILL = (
    'whole AS (SELECT "Source", ' + ", ".join(f'avg("{p}") AS "{p}"' for p in P) + ' FROM means GROUP BY ALL), '
    'lack AS (SELECT count(*) > 0 AS lacking FROM exact WHERE "Source" > 0 AND "CO" IS NULL), '
    'filled AS (SELECT e.* EXCLUDE (' + ", ".join(f'"{p}"' for p in P) + '), '
    + ", ".join(f'CASE WHEN e."Source" = 0 THEN 0 WHEN lacking THEN coalesce(e."{p}", c."{p}", g."{p}", 0) ELSE e."{p}" END AS "{p}"' for p in P)
    + ' FROM exact e LEFT JOIN curve c ON e."Source" = c."Source" AND e."SpeedBin" = c."SpeedBin" LEFT JOIN whole g ON e."Source" = g."Source", lack), '
    'total AS (SELECT *, m / 1000 AS km, ' + ", ".join(f'"{p}" * (m / 1000) AS "Total_{p}_g"' for p in P) + " FROM filled)"
)
EMIT = ", ".join([SEG, FEAT, RATES, CURVE, JOIN, FILL])
KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


def r6(*names: str) -> str:
    return ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)


def n6(expression: str, name: str) -> str:
    """Rounded as a decimal, as the catalogue's ``exact6``."""
    return f'CAST(round(CAST({expression} AS DECIMAL(28, 10)), 6) AS DOUBLE) AS "{name}"'


def w(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{'' if select.startswith(',') else ' '}{select}"


def share(column: str, table: str, extra: str = "") -> str:
    return f"SELECT {column}, count(*) AS n, round_even(count(*) * 100e0 / sum(count(*)) OVER (), 2) AS pct FROM {table} WHERE {column} IS NOT NULL {extra} GROUP BY {column}"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} * 100e0 / {whole} ELSE 0 END"


FIXED = """ids AS (SELECT event_id AS row, event_id % 48 // 4 AS r, event_id % 4 AS q FROM events),
    steps_ AS (SELECT row, q, i, r * 22 + i AS a, r * 22 + i + 1 AS b, 5 + q * 5 AS n FROM ids, (SELECT range AS i FROM range(20)) WHERE i < 5 + q * 5),
    st AS (SELECT s.*, e.length, e.travel_time, 20 + row * 17 % 211 AS leg_s, CASE WHEN q = 0 THEN 15e0 ELSE 100e0 END AS lim, row % 5 = 0 AS too_fast, sum(coalesce(travel_time, 0)) OVER (PARTITION BY row) AS ideal
           FROM steps_ s JOIN edges e ON e.graph = 'drive' AND e.u = s.a AND e.v = s.b),
    al AS (SELECT *, CASE WHEN ideal > 0 THEN leg_s * (coalesce(travel_time, 1) / ideal) ELSE leg_s / n END AS alloc FROM st),
    sp AS (SELECT *, CASE WHEN alloc > 0 THEN (length / 1000) / (alloc / 3600) ELSE 0 END AS kmh FROM al)"""

GAPS = raw() + """, gaps AS (SELECT * FROM (SELECT (epoch_us(utc) - epoch_us(lag(utc) OVER (PARTITION BY caid ORDER BY utc, ping_seq))) / 1e6 AS gap FROM raw) WHERE gap IS NOT NULL)"""
_CHAIN = ", ".join([PREP, TRIPS])
_ROUTES = ", ".join([_CHAIN, PLACES, LATTICE, KNN, LEGS])
DENS = [f'"{p}" AS "Densidad_{p}_g_km", "Total_{p}_g"' for p in P]
PUB = """pub AS (SELECT *, CAST(l_partkey AS VARCHAR) AS osmid, CAST(l_suppkey AS VARCHAR) AS start_node, CAST(l_suppkey + 1 AS VARCHAR) AS end_node, 25e0 + l_linenumber / 100e0 AS latitude, -100e0 - l_linenumber / 100e0 AS longitude,
    CASE WHEN l_linenumber <> 5 THEN 'POINT (' || l_suppkey || ' 25)' END AS geometry, strftime(lt, '%Y-%m-%d %H:%M:%S') AS fecha_kepler FROM total)"""
KEP = ", ".join(
    ["caid, trip, fecha_kepler", n6("kmh", "Speed [km/h]"), "osmid, highway, geometry", n6("m", "distance_m"), "mode AS modo_transporte"]
    + [x for p in P for x in (n6(f'"{p}"', f"Densidad_{p}_g_km"), n6(f'"Total_{p}_g"', f"Total_{p}_g"))]
    + [n6("latitude", "latitude"), n6("longitude", "longitude"), "start_node, end_node"]
)
LIGHT = ", ".join(["caid, fecha_kepler", n6("kmh", "Speed [km/h]"), "geometry", n6("m", "distance_m"), "mode AS modo_transporte", n6('"Total_CO2_g"', "Total_CO2_g")])


def _inventory(wanted: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{p}' AS pollutant, sum(\"Total_{p}_g\") AS grams FROM total" for p in wanted)
    return w(EMIT + f", inv AS ({rows})", "SELECT pollutant, round(grams, 3) AS grams, round(grams / 1000, 3) AS kg, round(grams * 100 / sum(grams) OVER (), 3) AS pct FROM inv")


ORACLES = {
    "ping_time_normalize": w(raw(), "SELECT caid, ping_seq, strftime(lt, '%Y-%m-%d %H:%M:%S.%f') AS local_time, epoch_us(lt) // 10000000 AS bucket FROM loc"),
    "user_sample_first_n": w(raw("user_id"), "SELECT caid, ping_seq FROM raw WHERE caid IN (SELECT caid FROM raw GROUP BY caid ORDER BY min(ping_seq) LIMIT 4)"),
    "downsample_10s_keep_last": w(", ".join([raw(), THIN]), f"SELECT caid, ping_seq, round(lat, 6) AS latitude, round(lon, 6) AS longitude FROM thin"),
    "geofence_haversine": w(", ".join([raw(), THIN, FENCE]), "SELECT caid, ping_seq, round(km, 6) AS distance_km FROM fence"),
    "sparse_id_filter": w(raw("user_id"), "SELECT caid, ping_seq FROM raw QUALIFY count(*) OVER (PARTITION BY caid) > 70"),
    "complete_days_shield": w(", ".join([raw(), THIN, FENCE, DENSE, DAYS]), "SELECT caid, ping_seq, CAST(day AS VARCHAR) AS day FROM days"),
    "lead_speed_vectors": w(PREP, "SELECT caid, ping_seq, round(m, 6) AS dis_lineal_m, round(kmh, 6) AS speed_kmh FROM vec"),
    "travel_time_recompute": w(PREP, "SELECT caid, ping_seq, round(tt, 6) AS travel_s FROM steps"),
    "trip_segmentation": w(_CHAIN, "SELECT caid, ping_seq, trip FROM seg", True),
    "near_infrastructure": w(", ".join([_CHAIN, NEAR, FLAGS]), "SELECT caid, ping_seq, near_subway_line, near_bus_route FROM flagged", True),

    "mode_classification": w(", ".join([_CHAIN, NEAR, FLAGS, MODE]), "SELECT f.caid, ping_seq, f.trip, CASE WHEN f.trip <= 0 THEN 'Parada' ELSE mode END AS mode FROM flagged f LEFT JOIN best b ON b.caid = f.caid AND b.day = f.day AND b.trip = f.trip", True),
    "ping_gap_describe": w(GAPS, "SELECT count(*) AS count, round(avg(gap), 4) AS mean, round(stddev_samp(gap), 4) AS std, round(min(gap), 4) AS min, round(max(gap), 4) AS max, " + ", ".join(f"round(quantile_cont(gap, {q}), 4) AS p{round(q * 100)}" for q in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) + " FROM gaps"),
    "ping_burst_counts": w(GAPS, "SELECT count(*) AS pings, " + ", ".join(f"count(*) FILTER (gap <= {s}) AS within_{s}s" for s in (1, 5, 10)) + ", " + ", ".join(f"round(count(*) FILTER (gap <= {s}) * 100e0 / count(*), 6) AS pct_{s}s" for s in (1, 5)) + " FROM gaps"),
    "stage_counts": w(", ".join([raw(), THIN, FENCE, DENSE, DAYS]), "SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM thin) AS thinned, (SELECT count(*) FROM dense) AS filtered, (SELECT count(*) FROM days) AS kept, (SELECT CAST(min(day) AS VARCHAR) FROM days) AS first_day, (SELECT CAST(max(day) AS VARCHAR) FROM days) AS last_day, round(((SELECT count(*) FROM raw) - (SELECT count(*) FROM thin)) * 100e0 / (SELECT count(*) FROM raw), 6) AS noise_pct"),
    "knn_edge_candidates": w(", ".join([raw(), THIN, FENCE, PLACES, LATTICE, KNN]), "SELECT round(lat, 4) AS latitude, round(lon, 4) AS longitude, array_to_string(nodes, ',') AS nodes FROM cand"),
    "shortest_path_lengths": w(", ".join([LATTICE, "origin AS (SELECT graph, node AS u FROM nodes)", KEYED_DISTANCES]), "SELECT graph, src AS u, node AS v, round(far, 6) AS length_m FROM dist WHERE src <> node", True),
    "route_pair_selection": w(", ".join([_ROUTES, PAIRS, KEYED_DISTANCES, SCORED]), """SELECT caid, CAST(day AS VARCHAR) AS day, CAST(row AS INTEGER) AS row, u, v, round(far, 6) AS length_m, round(score, 6) AS score, too_fast FROM sc
        QUALIFY row_number() OVER (PARTITION BY caid, day, row ORDER BY score >= 0.15, CASE WHEN score < 0.15 THEN 0 ELSE score END, i, j) = 1""", True),
    "route_continuity": w(", ".join([_ROUTES, PAIRS, KEYED_DISTANCES, SCORED, FOLD]), "SELECT caid, CAST(day AS VARCHAR) AS day, CAST(row AS INTEGER) AS row, b.u AS u, b.v AS v, start, b.f AS too_fast FROM fold WHERE row > 0", True),
    "edge_time_allocation": w(", ".join([LATTICE, FIXED]), """, cl AS (SELECT *, coalesce(sum(CAST(round(alloc * 1e6) AS BIGINT)) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM sp)
        SELECT row, CAST(i AS INTEGER) AS i, round(alloc, 6) AS alloc_s, round(kmh, 6) AS edge_kmh, strftime(TIMESTAMP '2024-01-01 06:00:00' + to_minutes(CAST(row AS INTEGER)) + to_microseconds(CAST(gone AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS edge_time FROM cl"""),
    "route_physics_correction": w(", ".join([LATTICE, FIXED]), """SELECT row, CAST(i AS INTEGER) AS i, round(CASE WHEN NOT (too_fast OR kmh > lim) THEN kmh WHEN length <= 250 THEN lim ELSE 0 END, 6) AS speed_out,
        round(CASE WHEN NOT (too_fast OR kmh > lim) THEN length WHEN length <= 250 THEN lim * 1000 / 3600 * alloc ELSE 0 END, 6) AS distance_m, (too_fast OR kmh > lim) AND length > 250 AS failed, (too_fast OR kmh > lim) AND length <= 250 AS corrected FROM sp"""),
    "stop_and_error_rows": w(_ROUTES, """SELECT caid, CAST(day AS VARCHAR) AS day, CAST(row AS INTEGER) AS row, trip, round(CASE WHEN trip > 0 THEN n.lat ELSE legs.lat END, 6) AS latitude, round(CASE WHEN trip > 0 THEN n.lon ELSE legs.lon END, 6) AS longitude, CAST(starts[1] AS VARCHAR) AS start_node, CAST(ends[1] AS VARCHAR) AS end_node,
        CASE WHEN trip > 0 THEN 'routing_error' ELSE 'parada_inactiva' END AS highway, trip > 0 AS failed FROM legs JOIN nodes n ON n.graph = 'drive' AND n.node = starts[1]""", True),
    "moves_features": w(", ".join([SEG, FEAT]), f'SELECT {KEY}, "Month", "Hour", "Day", "Road", "Source", "SpeedBin", round(mph, 6) AS avg_speed_mph FROM feats'),
    "route_ordinals": w(SEG, f"SELECT {KEY}, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, segs.l_shipdate) - 1 AS orden_original FROM segs"),
    "rates_preaggregate": w(RATES, f'SELECT "Day", "Hour", "Road", "Source", "SpeedBin", {r6(*P)} FROM means'),
    "rates_exact_join": w(", ".join([SEG, FEAT, RATES, JOIN]), f'SELECT {KEY}, {r6(*P)} FROM exact WHERE "Source" > 0'),
    "rates_curve_ffill_bfill": w(", ".join([RATES, CURVE]), f'SELECT "Source", "SpeedBin", {r6(*P)} FROM curve'),
    "rates_imputation_cascade": w(EMIT, f'SELECT {KEY}, "Source", {r6(*P)} FROM total'),
    "emission_totals": w(EMIT, f"SELECT {KEY}, strftime(lt, '%Y-%m-%d %H:%M:%S') AS fecha_kepler, {n6('km', 'distance_km_calc')}, {', '.join(n6(f'"Total_{p}_g"', f'Total_{p}_g') for p in P)} FROM total"),
    "mode_share_records": w(SEG, share("mode", "segs")),
    "mode_share_distance": w(SEG, "SELECT mode, round(sum(m), 4) AS distance_m, round_even(sum(m) * 100 / sum(sum(m)) OVER (), 2) AS pct FROM segs GROUP BY mode"),
    "highway_top5": w(SEG, share("highway", "segs") + " ORDER BY n DESC, highway LIMIT 5"),
    "routing_success": w(SEG, "SELECT moving, failures, topology, failures - topology AS physics, round(failures * 100e0 / moving, 6) AS failed_pct, round(100 - failures * 100e0 / moving, 6) AS success_pct FROM (SELECT count(*) AS moving, count(*) FILTER (failed) AS failures, count(*) FILTER (highway = 'routing_error') AS topology FROM segs WHERE trip > 0)"),
    "correction_audit": w(SEG, f"SELECT 'moving' AS part, 'all' AS name, count(*) FILTER (corrected) AS n, round_even(count(*) FILTER (corrected) * 100e0 / count(*), 2) AS pct FROM segs WHERE trip > 0 UNION ALL SELECT 'mode', * FROM ({share('mode', 'segs', 'AND corrected')}) UNION ALL SELECT 'highway', * FROM ({share('highway', 'segs', 'AND corrected')} ORDER BY n DESC, highway LIMIT 5)"),
    "corrected_distance_describe": w(SEG, "SELECT count(*) AS count, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std, round(min(m), 6) AS min, round(max(m), 6) AS max, " + ", ".join(f"round(quantile_cont(m, {q}), 6) AS p{round(q * 100)}" for q in (0.25, 0.5, 0.75, 0.9, 0.95)) + " FROM segs WHERE corrected"),
    "pure_vs_synthetic_distance": w(SEG, "SELECT round(a, 6) AS pure_km, round(b, 6) AS synthetic_km, round(a + b, 6) AS total_km, round(a * 100 / (a + b), 6) AS pure_pct, round(b * 100 / (a + b), 6) AS synthetic_pct FROM (SELECT sum(m) FILTER (NOT corrected) / 1000 AS a, sum(m) FILTER (corrected) / 1000 AS b FROM segs WHERE trip > 0)"),
    "source_summary": w(EMIT, "SELECT \"Source\", CASE \"Source\" WHEN 0 THEN 'No Motorizado' WHEN 21 THEN 'Carro' WHEN 42 THEN 'Bus' ELSE 'Otro' END AS name, count(*) AS records, round(sum(km), 6) AS km, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS records_pct, round(sum(km) * 100 / sum(sum(km)) OVER (), 6) AS km_pct FROM total GROUP BY \"Source\""),
    "pollutant_inventory": _inventory([p for p in P if p != "CO2_Equiv"]),
    "local_inventory": _inventory([p for p in P if p not in ("CO2", "CO2_Equiv")]),
    "join_quality": w(EMIT, 'SELECT a AS motorised, b AS orphans, c AS zero_distance, round((a - b) * 100e0 / a, 6) AS success_pct FROM (SELECT count(*) AS a, count(*) FILTER ("CO2_Equiv" = 0) AS b, count(*) FILTER (m = 0) AS c FROM total WHERE "Source" > 0)'),
    "hourly_co2e_profile": w(EMIT, 'SELECT CAST(h AS INTEGER) AS "Hour", round(coalesce(kg, 0), 5) AS kg FROM (SELECT range AS h FROM range(1, 25)) LEFT JOIN (SELECT "Hour" AS h, sum("Total_CO2_Equiv_g") / 1000 AS kg FROM total WHERE "Source" > 0 GROUP BY 1) USING (h)'),
    "speed_bin_curve": w(EMIT, 'SELECT "SpeedBin", round(avg("CO2_Equiv"), 6) AS g_km FROM total WHERE "Source" > 0 GROUP BY "SpeedBin"'),
    "speed_describe_by_mode": w(SEG, "SELECT mode, count(*) AS segments, round_even(avg(kmh), 2) AS mean, round_even(stddev_samp(kmh), 2) AS std, round_even(min(kmh), 2) AS min, round_even(quantile_cont(kmh, 0.5), 2) AS median, round_even(quantile_cont(kmh, 0.75), 2) AS p75, round_even(max(kmh), 2) AS max FROM segs GROUP BY mode"),
    "speed_box_stats": w(SEG + ", q AS (SELECT mode, quantile_cont(kmh, 0.25) AS q1, quantile_cont(kmh, 0.5) AS median, quantile_cont(kmh, 0.75) AS q3 FROM segs GROUP BY mode)", "SELECT mode, q1, median, q3, min(kmh) FILTER (inside) AS whisker_low, max(kmh) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS fliers, max(kmh) AS max FROM (SELECT s.mode, kmh, q1, median, q3, kmh BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM segs s JOIN q USING (mode)) GROUP BY ALL"),
    "type_flattener": w(SEG, "SELECT caid, CASE WHEN l_linenumber = 3 THEN -1 ELSE trip END AS trip, CASE WHEN l_linenumber <> 3 THEN kmh END AS speed_kmh, CASE WHEN l_linenumber <> 3 THEN strftime(lt, '%Y-%m-%d %H:%M:%S') END AS local_time, failed AND l_linenumber <> 3 AS failed, highway, l_partkey, l_extendedprice FROM segs"),
    "kepler_export": w(", ".join([EMIT, PUB]), f"SELECT {KEP} FROM pub WHERE geometry IS NOT NULL"),
    "kepler_light": w(", ".join([EMIT, PUB]), f"SELECT {LIGHT} FROM pub"),
    "kepler_superlight": w(", ".join([EMIT, PUB]), f"SELECT {LIGHT}, highway FROM pub WHERE highway IS DISTINCT FROM 'routing_error'"),
}
_EDGE_ENDS = "links JOIN nodes a ON a.graph = 'drive' AND a.node = u JOIN nodes b ON b.graph = 'drive' AND b.node = v"
_PIECES = line_table("metro", METRO_LINES)
_T = "greatest(0, least(1, coalesce((({x} - x1) * (x2 - x1) + ({y} - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0)))"
_METRO = ", ".join(
    [
        LATTICE,
        _PIECES,
        utm("spots", "(SELECT * FROM nodes WHERE graph = 'drive')"),
        """pieces AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY lat1) AS seq FROM metro)),
    run AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY line_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM pieces),
    trip AS (SELECT a.node AS trip_id, a.x AS ax, a.y AS ay, b.x AS ex, b.y AS ey FROM spots a JOIN spots b ON b.node = (a.node * 37 + 11) % 264),"""
        + f"""
    p AS (SELECT *, {_T.format(x='ax', y='ay')} AS s, {_T.format(x='ex', y='ey')} AS t FROM trip, run),
    q AS (SELECT *, sqrt(pow(x1 + s * (x2 - x1) - ax, 2) + pow(y1 + s * (y2 - y1) - ay, 2)) AS d, sqrt(pow(x1 + t * (x2 - x1) - ex, 2) + pow(y1 + t * (y2 - y1) - ey, 2)) AS e FROM p),
    beg AS (SELECT trip_id, line_id, gone + s * len AS lo FROM q QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY d, line_id, seq) = 1),
    fin AS (SELECT beg.*, gone + t * len AS hi FROM q JOIN beg USING (trip_id, line_id) QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY e, seq) = 1),
    stop AS (SELECT *, lo + (hi - lo) * n / 4 AS far FROM fin, (SELECT range AS n FROM range(5)))""",
    ]
)
ORACLES |= {
    "corrected_sample_1000": w(SEG, f"""SELECT {KEY}, caid, trip, mode FROM segs WHERE corrected
        ORDER BY md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || CAST(round(l_quantity) AS BIGINT) || '|' || CAST(round(l_extendedprice * 100) AS BIGINT) || '|' || strftime(l_shipdate, '%Y-%m-%d')) LIMIT 1000"""),
    "routing_losses": w(SEG, """SELECT count(*) AS user_days, count(*) FILTER (lost > 0) AS user_days_with_losses, CAST(sum(moving) AS BIGINT) AS moving, CAST(sum(lost) AS BIGINT) AS lost
        FROM (SELECT caid, CAST(lt AS DATE) AS day, count(*) FILTER (trip > 0) AS moving, count(*) FILTER (trip > 0 AND highway = 'routing_error') AS lost FROM segs GROUP BY ALL)"""),
    "pings_source": "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS ping_seq, user_id, round(value, 6) AS value FROM events",
    "rates_source": w(RATES, f'SELECT "Day", "Hour", "Road", "Source", "SpeedBin", {r6(*P)} FROM r2'),
    "routes_through_parquet": w(", ".join([EMIT, PUB]), f'SELECT {KEY}, caid, trip, fecha_kepler, {n6("kmh", "Speed [km/h]")}, {n6("m", "distance_m")}, highway FROM pub'),
    "kepler_csv_file": w(", ".join([EMIT, PUB]), f"SELECT {', '.join(x for x in KEP.split(', ') if x not in ('start_node', 'end_node'))} FROM pub WHERE geometry IS NOT NULL"),
    "kepler_geojson_file": w(", ".join([EMIT, PUB]), f"SELECT 'Feature' AS type, 'Point' AS shape, CAST(l_suppkey AS DOUBLE) AS lon, 25e0 AS lat, caid, trip, highway, start_node, end_node, {n6('m', 'distance_m')}, {n6('"Total_CO2_g"', 'Total_CO2_g')} FROM pub WHERE geometry IS NOT NULL"),
    "geojson_lines_source": w(LATTICE, f"SELECT u, v, round(a.lon, 6) AS lon1, round(a.lat, 6) AS lat1, round(b.lon, 6) AS lon2, round(b.lat, 6) AS lat2 FROM {_EDGE_ENDS}"),
    "metro_table_source": w(LATTICE, f"""SELECT 'points' AS layout, round(lon, 6) AS lon1, round(lat, 6) AS lat1, round(lon, 6) AS lon2, round(lat, 6) AS lat2 FROM nodes WHERE graph = 'drive'
        UNION ALL SELECT x, round(a.lon, 6), round(a.lat, 6), round(b.lon, 6), round(b.lat, 6) FROM {_EDGE_ENDS}, (VALUES ('WKT'), ('geometry')) l(x)"""),
    "walk_graph_fallback": w(LATTICE, "SELECT graph, u, v, round(length, 6) AS length FROM links, (VALUES ('drive'), ('walk')) g(graph)"),
    "projected_graph_cache": w(", ".join([LATTICE, utm("spots", "nodes")]), "SELECT graph, node, round(x, 3) AS x, round(y, 3) AS y FROM spots"),
    "metro_course": w(_METRO, "SELECT trip_id, CAST(n AS INTEGER) AS n, round(x1 + CASE WHEN len > 0 THEN (far - gone) / len ELSE 0 END * (x2 - x1), 3) AS x, round(y1 + CASE WHEN len > 0 THEN (far - gone) / len ELSE 0 END * (y2 - y1), 3) AS y FROM stop JOIN run USING (line_id) WHERE far >= gone - 1e-9 AND far <= gone + len + 1e-9 QUALIFY row_number() OVER (PARTITION BY trip_id, n ORDER BY seq) = 1"),
}
# names of the places as Spark prints their rounded coordinates
ORACLES["nearest_line_distance"] = w(
    ", ".join([raw(), THIN, FENCE, PLACES, line_table("bus", BUS_LINES), distance("bus")]),
    "SELECT CAST(round(lat, 4) AS VARCHAR) || ' ' || CAST(round(lon, 4) AS VARCHAR) AS place, CAST(line_id AS BIGINT) AS line_id, round(d, 4) AS distance_m FROM d_bus QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY d, line_id) = 1",
)
