"""Sinks: Parquet, CSV exports and GeoJSON, all written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflux.functions import wkt
from roadflux.functions.bins import POLLUTANTS

_MASSES = [f"{kind}_{p}_{unit}" for p in POLLUTANTS for kind, unit in (("Densidad", "g_km"), ("Total", "g"))]
KEPLER = ["caid", "trip", "fecha_kepler", "Speed [km/h]", "osmid", "highway", "geometry", "distance_m", "modo_transporte", *_MASSES, "latitude", "longitude"]
KEPLER_GEO = [*KEPLER, "start_node", "end_node"]
LIGHT = ["caid", "fecha_kepler", "Speed [km/h]", "geometry", "distance_m", "modo_transporte", "Total_CO2_g"]
SUPER_LIGHT = ["caid", "fecha_kepler", "Speed [km/h]", "highway", "geometry", "distance_m", "modo_transporte", "Total_CO2_g"]
IDS = ["osmid", "start_node", "end_node", "caid"]


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that df has, in the order asked for."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def kepler(df: DataFrame, columns: list[str] = KEPLER) -> DataFrame:
    """Map export: wanted columns, rows with a geometry, ids as text."""
    out = present(df, columns).dropna(subset=["geometry"])
    return out.withColumns({c: F.col(c).cast("string") for c in IDS if c in out.columns})


def light(df: DataFrame) -> DataFrame:
    return present(df, LIGHT)


def super_light(df: DataFrame) -> DataFrame:
    """Without the rows of failed routing; rows of unknown highway stay."""
    return present(df, SUPER_LIGHT).where(~F.col("highway").eqNullSafe("routing_error"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header; ``single_file`` is for map tools and means one writing task."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def geojson_features(df: DataFrame) -> DataFrame:
    """One GeoJSON Feature a row, as text in ``value``."""
    rows = kepler(df, KEPLER_GEO)
    xy = F.transform(wkt.points(F.col("geometry")), lambda p: F.array(p.lon, p.lat))
    is_point = F.col("geometry").startswith("POINT")
    shape = F.when(is_point, F.concat(F.lit('{"type":"Point","coordinates":'), F.to_json(xy[0]), F.lit("}"))).otherwise(F.concat(F.lit('{"type":"LineString","coordinates":'), F.to_json(xy), F.lit("}")))
    properties = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "geometry"]), {"ignoreNullFields": "false"})
    return rows.select(F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}")).alias("value"))


def write_geojson(df: DataFrame, path: str) -> None:
    """A folder of newline-delimited Features (every part is readable alone, none is gathered)."""
    geojson_features(df).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, path: str) -> None:
    """One file with one FeatureCollection (EPSG:4326), for map tools: one task writes, row by row."""
    head = F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:4326"}},"features":[')
    spark = df.sparkSession
    body = geojson_features(df).withColumn("n", F.monotonically_increasing_id())
    body = body.select("n", F.concat(F.lit(","), "value").alias("value"))
    ends = spark.createDataFrame([(-2, "head"), (1 << 62, "tail")], "n bigint, value string")
    first = body.agg(F.min("n")).first()[0]
    body = body.withColumn("value", F.when(F.col("n") == first, F.expr("substr(value, 2)")).otherwise(F.col("value")))
    rows = body.unionByName(ends.select("n", F.when(F.col("value") == "head", head).otherwise("]}").alias("value")))
    rows.coalesce(1).sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)
