import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadflux.functions.bins import POLLUTANTS
from roadflux.operators import emissions, flatten, reports
from roadflux.sources import fixtures as fx
from roadflux.sources import readers, sinks

RATE = "Day int, Hour int, Road int, Source int, SpeedBin int, " + ", ".join(f"{p} double" for p in POLLUTANTS)
ROUTE = "id int, trip int, local_timestamp timestamp_ntz, highway string, mode string, speed_kmh double, distance_m double"
MONDAY = dt.datetime(2024, 1, 8, 9)


def rates(spark, rows):
    return spark.createDataFrame([(*k, *([v] * 7 if not isinstance(v, list) else v)) for k, v in rows], RATE)


def routes(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ROUTE)


def car(kmh, highway="primary", mode="Carro", metres=1000.0):
    return (1, MONDAY, highway, mode, kmh, metres)


def test_levels_of_imputation(spark):
    known = rates(spark, [((5, 10, 4, 21, 3), 10.0), ((5, 10, 4, 21, 3), 20.0), ((5, 11, 4, 21, 6), 8.0), ((5, 10, 4, 42, 40), 7.0)])
    rows = [car(15.0), car(35.0, "residential"), car(0.0), car(120.0), car(15.0, mode="Bus"), car(15.0, mode="Metro"), (-1, MONDAY, "primary", "Carro", 15.0, 1000.0)]
    got = {r.id: r for r in emissions.emissions(routes(spark, rows), known).collect()}
    assert got[0].CO == 15.0  # exact, duplicates averaged first
    assert got[1].CO == 15.0  # bin 5 is filled from bin 3
    assert got[2].CO == 15.0 and got[3].CO == 8.0  # before the first and after the last known bin
    assert got[4].CO == 7.0  # only a bin outside 1 to 16: the Source's mean
    assert got[5].CO == got[6].CO == 0.0
    assert got[0].Total_CO_g == 15.0 and got[0].fecha_kepler == "2024-01-08 09:00:00" and got[0].Hour == 10 and got[0].Day == 5


def test_unknown_source_falls_to_zero(spark):
    got = emissions.emissions(routes(spark, [car(15.0, mode="Bus")]), rates(spark, [((5, 10, 4, 21, 3), 1.0)])).first()
    assert got.CO == 0.0


def test_without_a_gap_in_the_first_pollutant_nothing_is_imputed(spark):
    known = rates(spark, [((5, 10, 4, 21, 3), [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0]), ((5, 11, 4, 21, 3), 9.0)])
    got = emissions.emissions(routes(spark, [car(15.0)]), known).first()
    assert got.CO == 1.0 and got.CO2 is None
    got = emissions.emissions(routes(spark, [car(15.0), car(15.0, "residential")]), known).where("id = 0").first()
    assert got.CO2 == 9.0  # any gap of CO opens the cascade for all


def test_routes_are_not_shuffled(spark):
    plan = emissions.emissions(routes(spark, [car(15.0)] * 3).repartition(3), fx.rates(spark))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text


def test_inventories_are_density_times_distance(spark):
    rows = routes(spark, [car(15.0, metres=m) for m in (100.0, 900.0)])
    done = emissions.emissions(rows, rates(spark, [((5, 10, 4, 21, 3), 2.0)]))
    got = {r.pollutant: r.grams for r in reports.inventory(done, ["CO2_Equiv"]).collect()}
    assert set(got) == set(POLLUTANTS) - {"CO2_Equiv"} and all(v == pytest.approx(2.0) for v in got.values())
    assert reports.join_quality(done).first().orphans == 0
    hours = reports.hourly_profile(done).orderBy("Hour").collect()
    assert len(hours) == 24 and hours[9].kg == pytest.approx(0.002) and hours[0].kg == 0


def test_reports_on_nothing(spark):
    none = routes(spark, [car(1.0)]).where("false").withColumns({"failed": F.lit(False), "corrected": F.lit(False)})
    assert reports.routing_success(none).first().success_pct == 100
    assert reports.pure_vs_synthetic(none).first().pure_pct == 0
    assert reports.record_share(none, "mode").count() == 0
    done = emissions.emissions(none, rates(spark, [((5, 10, 4, 21, 3), 2.0)]))
    assert reports.join_quality(done).first().success_pct == 0 and reports.hourly_profile(done).count() == 24


def test_shares_and_ties(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "mode string")
    assert [(r["mode"], r.n, r.pct) for r in reports.record_share(rows, "mode", 2).collect()] == [("c", 2, 50.0), ("a", 1, 25.0)]


def test_sample_is_repeatable_and_bounded(spark):
    rows = spark.range(50).withColumn("corrected", F.col("id") % 2 == 0)
    a, b = (sorted(r.id for r in reports.corrected_sample(rows.repartition(n), ["id"], 10).collect()) for n in (1, 5))
    assert a == b and len(a) == 10


def published(spark):
    rows = routes(spark, [car(15.0), car(30.0, "routing_error"), car(20.0, None)])
    done = emissions.emissions(rows, rates(spark, [((5, 10, 4, 21, 3), 2.0)]))
    shape = F.when(F.col("id") == 0, "LINESTRING (-100.3 25.6, -100.4 25.7)").when(F.col("id") == 1, "POINT (-100.3 25.6)")
    more = {"caid": F.lit(12345678901234), "osmid": F.lit(9), "geometry": shape, "latitude": F.lit(25.6), "longitude": F.lit(-100.3), "start_node": F.lit(1), "end_node": F.lit(2), "failed": F.lit(False), "corrected": F.lit(False)}
    return flatten.export_names(done.withColumns(more))


def test_exports(spark, tmp_path):
    done = published(spark)
    assert sinks.light(done).columns == sinks.LIGHT and sinks.light(done).count() == 3
    assert sinks.super_light(done).count() == 2  # an unknown highway stays
    assert sinks.kepler(done).count() == 2 and dict(sinks.kepler(done).dtypes)["caid"] == "string"
    assert len(sinks.KEPLER) == 25 and len(sinks.KEPLER_GEO) == 27
    sinks.write_csv(sinks.kepler(done), str(tmp_path / "k.csv"), single_file=True)
    back = spark.read.option("header", True).csv(str(tmp_path / "k.csv"))
    assert back.count() == 2 and "Speed [km/h]" in back.columns
    sinks.write_parquet(done, str(tmp_path / "p"))
    assert readers.read_parquet(spark, str(tmp_path / "p"), ["caid", "Total_CO2_g"]).columns == ["caid", "Total_CO2_g"]


def test_geojson_round_trip(spark, tmp_path):
    import json

    sinks.write_feature_collection(published(spark).repartition(2), str(tmp_path / "g"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    found = json.loads(text)
    assert found["type"] == "FeatureCollection" and len(found["features"]) == 2
    kinds = {f["geometry"]["type"]: f for f in found["features"]}
    assert kinds["LineString"]["geometry"]["coordinates"] == [[-100.3, 25.6], [-100.4, 25.7]]
    assert kinds["Point"]["properties"]["highway"] == "routing_error" and len(kinds["Point"]["properties"]) == 26


def test_sources(spark, tmp_path):
    import json

    shape = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": [[-100.1, 25.5], [-100.2, 25.6]]}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}}]}
    (tmp_path / "bus.geojson").write_text(json.dumps(shape, indent=1))
    assert readers.line_segments(readers.read_geojson_lines(spark, str(tmp_path / "bus.geojson"))).count() == 3
    for name, text, count in (("a", 'geometry\n"LINESTRING (0 0, 1 1, 2 2)"\n', 2), ("b", 'WKT\n"LINESTRING (0 0, 1 1)"\n', 1), ("c", "lat,lon\n1,2\n3,4\n", 2)):
        (tmp_path / f"{name}.csv").write_text(text)
        assert readers.line_segments(readers.read_metro(spark, str(tmp_path / f"{name}.csv"))).count() == count
    (tmp_path / "d.csv").write_text("x\n1\n")
    with pytest.raises(ValueError, match="metro"):
        readers.read_metro(spark, str(tmp_path / "d.csv"))


def test_raw_sources(spark, tmp_path):
    import pandas as pd

    frame = pd.DataFrame({"caid": ["a", "b"], "utc_timestamp": [1.7e9, 1.7e9], "latitude": [1.0, float("nan")], "longitude": [1.0, 2.0]})
    frame.to_parquet(tmp_path / "p.parquet")
    rows = readers.read_pings(spark, str(tmp_path / "p.parquet")).orderBy("ping_seq").collect()
    assert [r.ping_seq for r in rows] == [0, 1] and rows[1].latitude is None
    with pytest.raises(ValueError, match="utc_timestamp"):
        readers.time_column(spark.range(1))


def test_graph_sources(spark, tmp_path):
    drive = fx.lattice_nodes(spark).where("graph = 'drive'")
    assert readers.with_walk_fallback(drive).groupBy("graph").count().orderBy("graph").collect()[1][1] == 264
    assert readers.with_walk_fallback(fx.lattice_nodes(spark)).count() == 528
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert readers.cached_table(spark, str(tmp_path / "cache"), build).count() == 3
    assert len(calls) == 1


def test_flattener(spark):
    rows = spark.createDataFrame([("7", "1.5", "2024-01-01 00:00:00", None, 5), (None, "x", "never", "true", None)], "trip string, speed_kmh string, local_timestamp string, failed string, osmid int")
    a, b = flatten.flatten_types(rows).collect()
    assert (a.trip, a.speed_kmh, a.failed, a.osmid) == (7, 1.5, False, "5")
    assert (b.trip, b.speed_kmh, b.local_timestamp, b.failed, b.osmid) == (-1, None, None, True, None)
