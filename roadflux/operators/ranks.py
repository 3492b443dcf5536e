"""Exact percentiles by rank, without a task that sees all values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.storage import materialize


def percentiles(df: DataFrame, column: str, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """(by..., q array<double>): interpolated percentiles of ``column``, one row a group; nulls are left out, and so is a group of nulls.

    Equal values are counted first, so a value that a third of all rows have is one row.
    Ranges of distinct values are then numbered by themselves and on from the ranges before, as ordinals are,
    and only the values at the few wanted ranks are looked up.
    """
    by = by or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    ranged = materialize(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*by, "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    offsets = ranged.groupBy("_part").agg(F.sum("_n").alias("_all")).select("_part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_upto", F.sum("_n").over(inside)).join(F.broadcast(offsets), "_part")
    placed = materialize(placed.select(*by, "_v", (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_from"), (F.col("_before") + F.col("_upto")).alias("_to")))
    groups = placed.groupBy(*by).agg(F.min("_from").alias("_first"), F.max("_to").alias("_last"))
    wanted = groups.where("_last is not null").select(*by, "_first", (F.col("_last") - F.col("_first") - 1).alias("_top"), F.posexplode(F.array(*[F.lit(float(x)) for x in shares])).alias("_i", "_p"))
    wanted = wanted.withColumns({"_low": F.floor(F.col("_p") * F.col("_top")), "_at": F.col("_p") * F.col("_top")})
    ends = wanted.select(*by, "_i", F.explode(F.array(F.struct((F.col("_first") + F.col("_low")).alias("_rank"), (1 - (F.col("_at") - F.col("_low"))).alias("_w")), F.struct((F.col("_first") + F.ceil("_at")).alias("_rank"), (F.col("_at") - F.col("_low")).alias("_w")))).alias("_e"))
    ends = ends.select("_i", "_e._rank", "_e._w").withColumnRenamed("_i", "_share")
    met = placed.join(F.broadcast(ends), (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))  # a few ranks a group
    # the lower value plus the part of the way to the upper one
    both = met.groupBy(*by, "_share").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"), F.max_by("_w", F.struct("_v", "_rank")).alias("_w"))
    values = both.select(*by, "_share", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")).alias("_q"))
    return values.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_share", "_q"))).alias("_s")).select(*by, F.transform("_s", lambda x: x["_q"]).alias("q")).where("size(q) > 0")
