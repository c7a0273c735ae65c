"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: With it Spark removes a query's shuffle files at its end, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_kept: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local one only where that is unset and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/folium-scratch"
    return f"{base.rstrip('/')}/folium/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def kept() -> int:
    """How many tables the operators have kept for lazy results so far, for close()."""
    return len(_kept)


def close(spark: SparkSession, since: int = 0, but: DataFrame | None = None) -> None:
    """Delete the tables kept since a count of kept(), all but one; frames that read them can't be read any more."""
    spared = getattr(but, "_scratch", None)
    for path in _kept[since:]:
        if path != spared:
            delete(spark, path)
    _kept[since:] = [path for path in _kept[since:] if path == spared]


def tidy_write(spark: SparkSession, write) -> None:
    """Call `write`, a query's execution, and have Spark remove its shuffle files at its end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        write()
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Scratch:
    """Tables that an operator writes on its way. At the end of the `with` block all but the kept ones are deleted.

    A stored frame's lineage is cut, and it outlives executors. What comes out of the block may read kept tables
    alone; those stay in the shared folder until close(), since nobody knows when a lazy frame is read last.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: set[str] = set()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            delete(self.spark, path)

    def keep(self, df: DataFrame) -> DataFrame:
        """The frame, written as Parquet and read again; it stays."""
        out = self._write(df)
        _kept.append(out._scratch)
        return out

    def stored(self, df: DataFrame) -> DataFrame:
        """The same until the block ends."""
        out = self._write(df)
        self._paths.add(out._scratch)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a stored table before the block ends."""
        self._paths.discard(df._scratch)
        delete(self.spark, df._scratch)

    def _write(self, df: DataFrame) -> DataFrame:
        path = folder(self.spark)
        tidy_write(self.spark, lambda: df.write.parquet(path))
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out
