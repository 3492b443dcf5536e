"""A bitmap of fixed size that lets most rows skip a join.

The key set is folded into ``BITS`` bits, built with Spark's bitmap aggregates
and broadcast: one megabyte at the most, whatever the size of the set.  A row
whose bit is clear has no partner for certain and need not be shuffled; rows
whose bit is set go through the exact join.  With a set so large that most bits
are set the sieve passes nearly everything, and the join does all the work, as it would
without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(77)), F.lit(BITS))


def with_maybe(df: DataFrame, key: str, members: DataFrame, member: str, name: str) -> DataFrame:
    """df with boolean ``name``: false only where ``key`` is certainly not among ``members.member``."""
    place = _place(F.col(member).cast("bigint"))
    bits = members.select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
    own = df.withColumn("_p", _place(F.col(key).cast("bigint"))).withColumn("_bucket", F.bitmap_bucket_number("_p"))
    met = own.join(F.broadcast(bits), "_bucket", "left")  # at most BITS / 32768 rows of 4 KB
    at = F.bitmap_bit_position("_p")
    byte = F.conv(F.hex(F.substr(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    is_set = F.bit_get(byte, (at % 8).cast("int")) == 1
    return met.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_p", "_bucket", "_bits")
