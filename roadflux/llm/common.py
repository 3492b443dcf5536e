"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflux.storage import materialize

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder that the session names."""
    return materialize(df)


def rekey(column: str) -> Column:
    """The same bigint under an expression of its own.

    An aggregate's output is already hash-partitioned by its key, and a join on
    that key would reuse the partitioning - which also forbids AQE to split a
    skewed partition of the other side.  Through this expression the planner
    gives both sides an exchange, and the skew-join rule applies.
    """
    return F.col(column).bitwiseXOR(F.lit(0).cast("bigint")).alias(column)


def bounded_texts(docs: DataFrame, chosen: DataFrame, total_bytes: int, longest_bytes: int) -> DataFrame:
    """chosen's columns + text for the rows of chosen(doc_id, ...), a table of few rows, that have a text.

    A doc_id that several rows share stands for the least text among them.  Texts
    beyond ``longest_bytes`` are not drawn, and in the order of the ids' hashes
    texts are drawn until ``total_bytes`` are reached.
    """
    own = chosen.columns
    picked = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").groupBy(*own).agg(F.min("text").alias("text"))
    picked = checkpointed(picked.withColumn("_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")))
    order = Window.partitionBy().orderBy(F.xxhash64(*own), *own)  # ids and sizes of the few chosen rows only
    drawn = picked.where(F.col("_bytes") <= longest_bytes).select(*own, F.sum("_bytes").over(order).alias("_upto")).where(F.col("_upto") <= total_bytes).drop("_upto")
    return picked.join(F.broadcast(drawn), own).drop("_bytes")


def without_clashes(rows: DataFrame, key: str, check: str) -> DataFrame:
    """rows whose 64-bit ``key`` is the same only where the second digest ``check`` is the same as well.

    Rows of a key that stands for several checks get another key each, drawn
    again until none clashes; null keys stay null.  rows should be materialised.
    """
    salt = 0
    while True:
        clashing = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(check).alias("_a"), F.max(check).alias("_b")).where("_a != _b").select(rekey(key), F.lit(True).alias("_clash"))
        clashing = checkpointed(clashing)
        if clashing.isEmpty():
            return rows
        salt += 1
        drawn = F.when(F.col("_clash"), F.xxhash64(key, check, F.lit(salt))).otherwise(F.col(key))
        rows = checkpointed(rows.join(clashing, key, "left").withColumn(key, drawn).drop("_clash"))


def learns(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; null ids count as remainder 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(0))
