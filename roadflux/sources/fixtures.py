"""Domain inputs derived from the general-purpose test tables, as FIXTURES.md describes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
METRO_LINES = ["LINESTRING (-100.3175 25.6861, -100.2755 25.6861)", "LINESTRING (-100.3165 25.6900, -100.3165 25.7080, -100.2900 25.7080)"]
BUS_LINES = ["LINESTRING (-100.3175 25.6976, -100.2755 25.6976)", "LINESTRING (-100.2968 25.6850, -100.2968 25.7080)", "LINESTRING (-100.3175 25.6856, -100.2755 25.7076)"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pings(spark: SparkSession, sf_dir: str, fold: int | None = 4) -> DataFrame:
    """(caid, ping_seq, utc_timestamp, latitude, longitude); ``fold``: number of users, None for all."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    caid = F.col("user_id") % fold if fold else F.col("user_id")
    lon = F.lit(-100.3161) + F.when(F.col("value") > 250, 0.6).otherwise(F.floor(F.col("value") / 50) * 0.01)
    return events.select(
        caid.cast("string").alias("caid"), F.col("event_id").alias("ping_seq"), F.col("ts").cast("timestamp_ntz").alias("utc_timestamp"),
        (F.lit(25.6866) + F.floor(k / 34) * 0.01).alias("latitude"), lon.alias("longitude"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for completed routes; ORDER is its unique key."""
    rows = table(spark, sf_dir, "lineitem")
    parked = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") >= 6)
    pick = lambda column, names: F.element_at(F.array(*[F.lit(x) for x in names]), (column + 1).cast("int"))
    highway = pick(F.col("l_suppkey") % 8, ["motorway", "primary", "secondary", "residential", "living_street", "routing_error", "parada_inactiva", "trunk_link"])
    return rows.select(
        *ORDER, F.col("l_orderkey").cast("string").alias("caid"), (F.col("l_linenumber") * F.when(parked, -1).otherwise(1)).alias("trip"),
        F.timestamp_add("HOUR", F.col("l_partkey") % 24, F.col("l_shipdate").cast("timestamp_ntz")).alias("local_timestamp"),
        (F.col("l_quantity") * 3 - 3).alias("speed_kmh"), (F.col("l_extendedprice") / 100).alias("distance_m"),
        pick(F.col("l_partkey") % 4, ["Carro", "Bus", "Metro", "Caminar"]).alias("mode"), highway.alias("highway"),
        (F.col("l_discount") >= 0.09).alias("failed"), (F.col("l_tax") >= 0.07).alias("corrected"),
    )


def rates(spark: SparkSession) -> DataFrame:
    """Emission rates from integers: gaps, nulls and duplicate keys included."""
    i = F.col("i")
    base = spark.range(3072).select(F.col("id").cast("int").alias("i"))
    # floor keeps the quotients integral under any division rules
    div = lambda n: F.floor(i / n)
    base = base.withColumns(
        {
            "Day": F.when(div(1536) % 2 == 0, 5).otherwise(2), "Hour": (1 + div(64) % 24).cast("int"), "Road": (4 + div(32) % 2).cast("int"),
            "Source": F.when(div(16) % 2 == 0, 21).otherwise(42), "SpeedBin": 1 + i % 16,
        }
    )
    base = base.where((i % 7 != 3) & ~((F.col("Source") == 42) & (F.col("SpeedBin") >= 15)))
    base = base.withColumns(
        {
            "CO": 1 + (i * 37 % 101) / 10, "CO2": 100 + (i * 41 % 197) / 2, "CO2_Equiv": F.when(i % 13 != 0, 110 + (i * 43 % 199) / 2), "HC": (i * 47 % 83) / 100 + 0.01,
            "NOx": F.when(i % 11 != 0, 2 + (i * 53 % 89) / 100), "PM10": (i * 59 % 71) / 1000 + 0.001, "PM25": F.when(i % 17 != 0, (i * 61 % 67) / 1000 + 0.001),
        }
    )
    return base.unionByName(base.where(i % 5 == 0).withColumn("CO", F.col("CO") + 0.5)).drop("i")


def lines(spark: SparkSession, texts: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), "line_id bigint, geometry string")


def lattice_nodes(spark: SparkSession) -> DataFrame:
    """(graph, node, lon, lat): 12 x 22 nodes, the same for both graphs."""
    grid = spark.range(264).select(F.floor(F.col("id") / 22).alias("i"), (F.col("id") % 22).alias("j"), F.col("id").alias("node"))
    place = grid.select("node", (F.lit(-100.3171) + F.col("j") * 0.002).alias("lon"), (F.lit(25.6856) + F.col("i") * 0.002).alias("lat"))
    return place.withColumn("graph", F.explode(F.array(F.lit("drive"), F.lit("walk")))).select("graph", "node", "lon", "lat")


def lattice_edges(spark: SparkSession) -> DataFrame:
    """Directed 4-neighbour edges; walking lacks a few of them."""
    grid = spark.range(264).select(F.floor(F.col("id") / 22).alias("i"), (F.col("id") % 22).alias("j"), F.col("id").alias("u"))
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    each = grid.withColumn("s", F.explode(steps)).withColumns({"i2": F.col("i") + F.col("s.a"), "j2": F.col("j") + F.col("s.b")})
    each = each.where("i2 between 0 and 11 and j2 between 0 and 21").withColumn("v", F.col("i2") * 22 + F.col("j2"))
    base = F.when(F.col("i") != F.col("i2"), 222.4).otherwise(200.4)
    size = base * (1 + ((37 * F.col("i") + 61 * F.col("j") + 17 * F.col("i2") + 29 * F.col("j2")) % 97) / 97 * 0.25)
    each = each.select("u", "v", F.lit(0).alias("key"), size.alias("length"))
    each = each.withColumns({"travel_time": F.when((F.col("u") + F.col("v")) % 19 != 0, F.col("length") / 8.33), "osmid": (F.col("u") * 1000 + F.col("v")).cast("string"), "highway": F.when(F.col("u") % 5 != 0, F.when(F.col("u") % 2 == 0, "primary").otherwise("residential")), "geometry": F.lit(None).cast("string")})
    both = each.withColumn("graph", F.explode(F.array(F.lit("drive"), F.lit("walk"))))
    return both.where("graph = 'drive' or (u * 7 + v) % 23 != 0").select("graph", "u", "v", "key", "length", "travel_time", "osmid", "highway", "geometry")
