"""Session defaults: UTC, ANSI, adaptive execution; sizes are left to the cluster."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # pandas writes nanosecond timestamps; readers.py turns these integers into timestamps
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def get_session(name: str = "roadflux", cores: int | None = None, memory: str = "8g") -> SparkSession:
    """The active session, or a local one for tests and benchmarks."""
    cores = cores or os.cpu_count() or 1
    builder = SparkSession.builder.appName(name).master(f"local[{cores}]").config(map=SETTINGS)
    builder = builder.config("spark.sql.shuffle.partitions", cores).config("spark.driver.memory", memory)
    return builder.config("spark.ui.enabled", "false").getOrCreate()
