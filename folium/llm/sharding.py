"""A store of immutable shards with size-tiered compaction and versioned manifests.

DataFrame and SQL functions only. Arrivals are appended as small shards; compaction merges runs of similar size
into shards of about the target size, and brings the rows of larger arrivals together in files of that size. Each
change writes new files, then a new manifest beside the others, and renames it to the next version: readers see the
old version or the new one, and a second writer of the same version fails. Nothing that a manifest names is ever
rewritten; a job that dies leaves files that no manifest names. A row lies in a struct of its own, so that its
columns may have any names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from folium.llm.columns import free_names
from folium.llm.scratch import tidy_write

#: Documents whose ids share this quotient arrive together.
ARRIVAL_ROWS = 2000
#: Bytes of text that a merged shard, and a file of a larger one, is to hold. Shards of half as many are not merged.
TARGET_BYTES = 128 << 20
#: Sizes whose logarithm to the base 4 has the same whole part form a tier.
FANOUT = 4
#: Only shards whose first arrivals share this quotient merge, so that planning is never one task's work.
SPAN = 4096


def arrival_of(doc_id: Column, rows: int = ARRIVAL_ROWS) -> Column:
    """The arrival of a document: the quotient of its id; -1 for null."""
    return F.coalesce(F.floor(doc_id / rows), F.lit(-1))


class ShardStore:
    """Shards and manifests in one folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, target: int = TARGET_BYTES):
        self.spark, self.path, self.target = spark, path.rstrip("/"), target

    def _files(self, *parts: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        where, files = self._files("manifests")
        names = [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []
        return max((int(n[1:]) for n in names if n[:1] == "v"), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """One row a shard of a version, the newest unless named: shard, seq (its first arrival), last, size, n, folder."""
        return self.spark.read.parquet(f"{self.path}/manifests/v{self.version() if version is None else version:06d}")

    def _commit(self, manifest: DataFrame, base: int) -> int:
        """Make a manifest the version after `base`; fails if another writer was first."""
        draft = f"draft-{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(f"{self.path}/manifests/{draft}")
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        source, target = self._files("manifests", draft)[0], self._files("manifests", f"v{base + 1:06d}")[0]
        options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration()).rename(source, target, options)
        return base + 1

    def _write(self, rows: DataFrame, under: str) -> str:
        """Rows with their shard's name, as one folder for each shard in a new folder, whose name begins as told."""
        folder = f"{under}-{uuid.uuid4().hex}"
        tidy_write(self.spark, lambda: rows.write.partitionBy("shard").option("compression", "zstd").parquet(f"{self.path}/rows/folder={folder}"))
        return folder

    def append(self, docs: DataFrame, arrival: Column, size: Column) -> int:
        """Add rows, each arrival as a shard of its own; `size` is the bytes that a row counts.

        The rows of an arrival are brought together before they are written; a large arrival is split among tasks.
        Null values of any column, repeated rows and texts of any length are kept; no rows make a version without
        new shards.
        """
        base = self.version()
        before = self.manifest(base) if base else None
        rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("n_bytes"), F.concat(arrival.cast("string"), F.lit(f"-v{base + 1}")).alias("shard"))
        tidy_write(self.spark, lambda: self.spark.createDataFrame([], rows.schema).write.parquet(f"{self.path}/schemas/{uuid.uuid4().hex}-v{base + 1}"))
        folder = self._write(rows.hint("rebalance", "shard"), "data")
        added = self._read([folder], rows.schema).groupBy("shard").agg(F.sum("n_bytes").alias("size"), F.count("*").alias("n"))
        seq = F.regexp_extract("shard", r"^(-?\d+)", 1).cast("long")
        added = added.select("shard", seq.alias("seq"), seq.alias("last"), "size", "n", F.lit(folder).alias("folder"))
        return self._commit(before.unionByName(added) if before is not None else added, base)

    def _read(self, folders: list[str], schema: StructType | None = None) -> DataFrame:
        """The rows of folders in one scan, with their folder and shard; columns that an append lacked are null."""
        reader = self.spark.read.option("basePath", f"{self.path}/rows").schema(self._schema() if schema is None else schema)
        rows = reader.parquet(*(f"{self.path}/rows/folder={x}" for x in folders))
        if "folder" not in rows.columns:  # nothing but folders without rows
            rows = rows.withColumn("folder", F.lit(None))
        return rows.withColumns({"folder": F.col("folder").cast("string"), "shard": F.col("shard").cast("string")})

    def _schema(self) -> StructType:
        """The columns of all appends together, from the empty tables that they left."""
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/schemas/*").schema

    def plan(self) -> DataFrame:
        """The newest shards that are to be rewritten, with the new shard of each and the files that it gets.

        Shards under half the target are dealt to tiers by size; in a tier and span, in the order of arrival, neighbours
        go together until they fill the target. Groups of one are left alone. Larger shards that still lie as they
        arrived keep their names and get a file for each target size begun.
        """
        base = self.version()
        manifest = self.manifest(base)
        small = manifest.filter(F.col("size") < self.target // 2)
        tier = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1))) / F.lit(float(FANOUT.bit_length() - 1)))
        small = small.withColumn("tier", tier).withColumn("span", F.floor(F.col("seq") / F.lit(SPAN)))
        before = F.coalesce(F.sum("size").over(Window.partitionBy("tier", "span").orderBy("seq", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        small = small.withColumn("part", F.floor(before / F.lit(self.target)))
        group = Window.partitionBy("tier", "span", "part")
        name = F.concat_ws("-", F.min("seq").over(group).cast("string"), F.max("last").over(group).cast("string"), F.concat(F.lit("t"), F.col("tier").cast("string")), F.lit(f"v{base + 1}"))
        small = small.withColumn("runs", F.count("*").over(group)).withColumn("into", name).filter("runs > 1").drop("part", "runs", "tier", "span").withColumn("files", F.lit(1).cast("long"))
        large = manifest.filter((F.col("size") >= self.target // 2) & F.col("folder").startswith("data-"))
        return small.unionByName(large.withColumn("into", F.col("shard")).withColumn("files", F.ceil(F.col("size") / F.lit(self.target))))

    def compact(self) -> int:
        """Rewrite what plan() names and commit; without anything to rewrite the version stays."""
        base = self.version()
        manifest = self.manifest(base)
        plan = self.plan()
        folders = [r["folder"] for r in plan.select("folder").distinct().collect()]
        if not folders:
            return base
        # files are numbered through, so that each is one task's
        made = plan.groupBy(F.col("into").alias("shard")).agg(F.min("seq").alias("seq"), F.max("last").alias("last"), F.sum("size").alias("size"), F.sum("n").alias("n"), F.max("files").alias("files"))
        first = made.select(F.col("shard").alias("into"), (F.sum("files").over(Window.orderBy("shard")) - F.col("files")).alias("first"))
        merges = plan.select("shard", "folder", "into", "files").join(first, "into")
        # a row's place in the store deals it to a file, so that equal rows spread and a repeated task deals alike
        file = F.pmod(F.xxhash64("__at.file_path", "__at.row_index"), F.col("files"))
        # the list of shards is small beside their rows, and of the folders read only the rewritten ones stay
        rows = self._read(folders)
        rows = rows.select("row", "n_bytes", "shard", "folder", F.col("_metadata").alias("__at")).join(merges, ["shard", "folder"])
        rows = rows.select("row", "n_bytes", F.col("into").alias("shard"), (F.col("first") + file).cast("int").alias("__file"))
        # a merged shard has the target's size at most and one small one more: it fits a task
        count = made.agg(F.sum("files")).first()[0]
        folder = self._write(rows.repartitionById(count, F.col("__file")).drop("__file"), "merged")
        made = made.drop("files").withColumn("folder", F.lit(folder))
        kept = manifest.join(merges.select("shard", "folder"), ["shard", "folder"], "left_anti").select(manifest.columns)
        return self._commit(kept.unionByName(made), base)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version with the shard and n_bytes of each; these get underscores if rows have such columns.

        A version without shards has no rows, and the columns of all appends.
        """
        manifest = self.manifest(version)
        folders = [r["folder"] for r in manifest.select("folder").distinct().collect()]
        if folders:
            rows = self._read(folders).join(manifest.select("shard", "folder"), ["shard", "folder"], "left_semi").select("row", "n_bytes", "shard")
        else:
            rows = self.spark.createDataFrame([], self._schema())
        columns = rows.schema["row"].dataType.names
        return rows.select("row.*", "n_bytes", "shard").toDF(*columns, *free_names(columns, ("n_bytes", "shard")))
