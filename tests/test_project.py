import json

import pytest
from pyspark.sql import functions as F

from roadflux.operators.flatten import with_ordinal
from roadflux.plans import project
from roadflux.sources import fixtures as fx
from roadflux.sources import sinks


def pairs(text):
    return [[float(v) for v in p.split()] for p in text[text.index("(") + 1 : -1].split(", ")]


def test_files_to_files(spark, tmp_path):
    """Input files to all outputs; the invariants that tie them together hold."""
    inputs, outputs = tmp_path / "in", tmp_path / "out"
    inputs.mkdir()
    rows = []
    for user in range(2):
        for day in range(4):
            for i in range(30):
                rows.append((f"u{user}", 1704153600 + 86400 * day + 65 * i * (1 + user), 25.6866 + 0.001 * (i // 4), -100.3161 + 0.002 * (i % 7)))
    spark.createDataFrame(rows, "caid string, utc_timestamp bigint, latitude double, longitude double").coalesce(1).write.parquet(str(inputs / "pings.parquet"))
    fx.lattice_nodes(spark).where("graph = 'drive'").write.parquet(str(inputs / "nodes.parquet"))
    fx.lattice_edges(spark).where("graph = 'drive'").write.parquet(str(inputs / "edges.parquet"))
    fx.rates(spark).write.parquet(str(inputs / "rates.parquet"))
    (inputs / "bus.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": pairs(t)}} for t in fx.BUS_LINES]}))
    (inputs / "metro.csv").write_text("geometry\n" + "\n".join(f'"{t}"' for t in fx.METRO_LINES) + "\n")

    found = {k: v.collect() for k, v in project.run(spark, str(inputs), str(outputs)).items()}
    routes, final = spark.read.parquet(str(outputs / "routes")), spark.read.parquet(str(outputs / "emissions"))
    assert len(routes.columns) == 15 and len(final.columns) == 46
    assert routes.count() == final.count() > 100
    assert sorted(r[0] for r in final.select("orden_original").collect()) == list(range(final.count()))
    assert sum(r.pct for r in found["mode_share_records"]) == pytest.approx(100, abs=0.05)
    success = found["routing_success"][0]
    assert success.failures == success.topology + success.physics
    assert success.moving == routes.where("trip > 0").count()
    total = final.where("Source > 0").agg(F.sum(F.col("Densidad_CO2_g_km") * F.col("distance_m") / 1000)).first()[0]
    assert {r.pollutant: r.grams for r in found["pollutant_inventory"]}["CO2"] == pytest.approx(total)
    limits = {"Caminar": 15, "Bus": 100, "Metro": 120, "Carro": 150}
    assert all(r.max <= limits.get(r["mode"], 150) + 1e-9 for r in found["speed_by_mode"])
    light = spark.read.option("header", True).csv(str(outputs / "kepler_light_csv"))
    assert light.columns == sinks.LIGHT and light.count() == final.count()
    one = spark.read.text(str(outputs / "kepler_geojson")).first()[0]
    assert json.loads(one)["type"] == "Feature"


def test_first_user_only(spark):
    pings = fx.pings(spark, "/root/testdata/sf0.001")
    edges, nodes = fx.lattice_edges(spark), fx.lattice_nodes(spark)
    out = project.routes(pings, fx.lines(spark, fx.METRO_LINES), fx.lines(spark, fx.BUS_LINES), edges, nodes, users=1)
    assert out.select("caid").distinct().count() == 1


def test_ordinals(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit(1).alias("x")).repartition(7)
    got = with_ordinal(df, ["k"]).collect()
    assert len(got) == 1000 and all(r.orden_original == r.k for r in got)
    assert with_ordinal(df.limit(0), ["k"]).count() == 0
