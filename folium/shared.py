"""Tables written on the way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local one only where that is unset and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/folium-shared"
    return f"{base.rstrip('/')}/folium/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: With it Spark removes a query's shuffle files at its end, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The frame as Parquet; its shuffle files go at its end."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The frame, written as Parquet and read again, and where: its lineage is cut, and it outlives executors."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    write(df, path)
    return spark.read.schema(df.schema).parquet(path), path
