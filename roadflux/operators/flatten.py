"""Final types of the route table and of its exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.storage import materialize

TEXT = ["caid", "start_node", "end_node", "osmid", "highway", "geometry", "mode"]
NUMBERS = ["latitude", "longitude", "speed_kmh", "distance_m"]
FLAGS = ["failed", "corrected"]
EXPORT = {"speed_kmh": "Speed [km/h]", "mode": "modo_transporte", "failed": "ruteo_fallido", "corrected": "corregido_espacialmente", "dis_lineal_m": "dis lineal [m]"}
ROUTE_ORDER = ["caid", "trip", "latitude", "longitude", "speed_kmh", "local_timestamp", "start_node", "end_node", "osmid", "highway", "geometry", "distance_m", "mode", "failed", "corrected"]


def flatten_types(df: DataFrame) -> DataFrame:
    """Text, numbers, time and flags in their final types; what cannot be read becomes null.

    A missing trip is -1, a missing flag false; missing text stays null.
    """
    casts = {c: F.col(c).cast("string") for c in TEXT}
    casts |= {c: F.expr(f"try_cast(`{c}` AS double)") for c in NUMBERS}
    casts |= {c: F.coalesce(F.expr(f"try_cast(`{c}` AS boolean)"), F.lit(False)) for c in FLAGS}
    casts["trip"] = F.coalesce(F.expr("try_cast(trip AS int)"), F.lit(-1))
    casts["local_timestamp"] = F.expr("try_cast(local_timestamp AS timestamp_ntz)")
    return df.withColumns({c: e for c, e in casts.items() if c in df.columns})


def route_table(routes: DataFrame) -> DataFrame:
    """The 15 route columns under their published names."""
    return export_names(flatten_types(routes).select(*ROUTE_ORDER))


def export_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(EXPORT)


def engine_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in EXPORT.items()})


def with_ordinal(df: DataFrame, keys: list[str], name: str = "orden_original") -> DataFrame:
    """df with 0, 1, 2, ... in the order of ``keys``, which must be unique.

    Ranges of keys are sorted by themselves and then numbered on from the sizes
    of the ranges before, so no task sees the whole table, as row_number() would.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
