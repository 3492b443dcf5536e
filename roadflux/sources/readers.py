"""Sources: pings, emission rates, transit lines, road graphs, route and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflux.functions import wkt
from roadflux.functions.bins import POLLUTANTS, nan_to_null

GEOJSON = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]))])))])


def clean(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column: Spark's aggregates would spread NaN."""
    return df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) if kind in ("double", "float") else F.col(f"`{c}`") for c, kind in df.dtypes])


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A table, NaN as null; with ``columns`` the scan reads no others."""
    df = spark.read.parquet(path)
    return clean(df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df)


def read_pings(spark: SparkSession, path: str) -> DataFrame:
    """Raw pings with ping_seq, the row's place in its file, where the files do not bring one.

    The time column is utc_timestamp if there is one, else date.
    """
    df = spark.read.parquet(path)
    if "ping_seq" not in df.columns:
        df = df.select("*", F.col("_metadata.row_index").alias("ping_seq"))
    return clean(df)


def time_column(df: DataFrame) -> str:
    for name in ("utc_timestamp", "date"):
        if name in df.columns:
            return name
    raise ValueError("pings need a column utc_timestamp or date")


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    keys = ["Day", "Hour", "Road", "Source", "SpeedBin"]
    df = read_parquet(spark, path, keys + POLLUTANTS)
    return df.select(*[F.col(k).cast("int") for k in keys], *[F.col(p).cast("double") for p in POLLUTANTS])


def read_geojson_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_id, geometry WKT): the lines of a FeatureCollection, multi-lines one by one."""
    found = spark.read.schema(GEOJSON).option("multiLine", True).json(path).select(F.explode("features.geometry").alias("g"))
    line, lines = "array<array<double>>", "array<array<array<double>>>"
    single = F.array(F.from_json("g.coordinates", line))
    shapes = F.when(F.col("g.type") == "LineString", single).when(F.col("g.type") == "MultiLineString", F.from_json("g.coordinates", lines))
    each = found.select(F.explode(shapes).alias("xy"))
    pairs = F.transform("xy", lambda p: F.concat(p[0].cast("string"), F.lit(" "), p[1].cast("string")))
    text = F.concat(F.lit("LINESTRING ("), F.array_join(pairs, ", "), F.lit(")"))
    return each.select(F.monotonically_increasing_id().alias("line_id"), text.alias("geometry"))


def lines_from_table(df: DataFrame) -> DataFrame:
    """(line_id, geometry WKT) of a metro table: a column geometry or WKT, else points in lat and lon."""
    row = F.monotonically_increasing_id().alias("line_id")
    for name in ("geometry", "WKT"):
        if name in df.columns:
            return df.select(row, F.col(name).cast("string").alias("geometry")).where("geometry is not null")
    if {"lat", "lon"} <= set(df.columns):
        return df.select(row, wkt.point(F.col("lon").cast("double"), F.col("lat").cast("double")).alias("geometry")).where("geometry is not null")
    raise ValueError("a metro table needs geometry, WKT, or lat and lon")


def read_metro(spark: SparkSession, path: str) -> DataFrame:
    return lines_from_table(spark.read.option("header", True).csv(path))


def line_segments(lines: DataFrame) -> DataFrame:
    """(line_id, seq, lon1, lat1, lon2, lat2); a point is a segment of no length."""
    each = lines.select("line_id", F.posexplode(wkt.parts(F.col("geometry"))).alias("part", "body"))
    each = each.select("line_id", "part", wkt.points(F.col("body")).alias("p"))
    last = F.when(F.size("p") > 1, F.size("p") - 1).otherwise(F.size("p"))
    ends = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(F.element_at("p", i).alias("a"), F.coalesce(F.try_element_at(F.col("p"), i + 1), F.element_at("p", i)).alias("b")))
    out = each.where(F.size("p") > 0).select("line_id", "part", F.posexplode(ends).alias("seq", "s"))
    return out.select("line_id", (F.col("part") * (1 << 31) + F.col("seq")).alias("seq"), F.col("s.a.lon").alias("lon1"), F.col("s.a.lat").alias("lat1"), F.col("s.b.lon").alias("lon2"), F.col("s.b.lat").alias("lat2"))


def with_walk_fallback(table: DataFrame) -> DataFrame:
    """Graph rows (column graph); without any of 'walk', the drive rows serve for walking too."""
    walk = table.where("graph = 'walk'").limit(1).select(F.lit(1).alias("has"))
    alias = table.where("graph = 'drive'").withColumn("graph", F.lit("walk")).join(F.broadcast(walk), F.lit(True), "left_anti")
    return table.unionByName(alias)


def cached_table(spark: SparkSession, path: str, build) -> DataFrame:
    """The Parquet table at ``path``; built and written first if there is none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        build().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)
