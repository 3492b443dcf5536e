"""Materialisation through the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one that the session names (``spark.checkpoint.dir``), else one below the SQL warehouse.

    Without a named folder, a warehouse on the local file system will do for a
    local master only; on a cluster executors would each write to their own disk.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        own = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not own and not context.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(own or warehouse + "/_checkpoints")
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage; lost executors do not bring it back to the sources."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(df: DataFrame) -> None:
    """Remove the files of a DataFrame that ``materialize`` returned and that nothing reads any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        drop_folder(df.sparkSession, file.get())
