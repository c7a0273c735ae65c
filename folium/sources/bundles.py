"""Bundles: a document with its sections, runs and questions in one checksummed JSON file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import text as T

CHUNK = "struct<ordinal:int, text:string, page_start:int, page_end:int>"
NODE = f"struct<ref:string, parent_ref:string, level:int, level_label:string, ordinal:string, title:string, page_start:int, page_end:int, chunks:array<{CHUNK}>>"
RUN = "struct<ref:string, model:string, mode:string, status:string, started_at:string, completed_at:string, nodes_total:int, nodes_completed:int, nodes_failed:int, cost_usd:double>"
OPTION = "struct<order_in_question:int, role:string, text:string, is_correct:boolean>"
QUESTION = f"struct<run_ref:string, node_ref:string, question:string, justification:string, status:string, options:array<{OPTION}>>"
SCHEMA = f"bundle_id string, version int, generated_at string, manual struct<code:string, edition:string, title:string, branch:string, source_sha256:string>, metadata map<string,string>, nodes array<{NODE}>, runs array<{RUN}>, questions array<{QUESTION}>"


def build(documents: DataFrame, nodes: DataFrame, chunks: DataFrame, runs: DataFrame, questions: DataFrame) -> DataFrame:
    """One bundle a document, by SCHEMA; lists are in the order of their stable keys, so equal stores give equal bundles.

    documents: doc_id, code, edition, title, branch, source_sha256, generated_at (timestamp), metadata. nodes: doc_id,
    sort_key, parent_key, level, level_label, ordinal, title, page_start, page_end, node_id. chunks: node_id, ordinal,
    text, page_start, page_end. runs: doc_id, run_id, model, mode, status, started_at, completed_at, nodes_total,
    nodes_completed, nodes_failed, cost_estimate_usd. questions: doc_id, run_id, node_id, question_text,
    justification, status, generation_order, options.
    """
    c = chunks.groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct(F.col("ordinal").cast("int").alias("ordinal"), "text", "page_start", "page_end"))).alias("chunks"))
    n = nodes.join(c, "node_id", "left").select("doc_id", F.struct(F.col("sort_key").alias("ref"), F.col("parent_key").alias("parent_ref"), "level", "level_label", "ordinal", "title", "page_start", "page_end", F.coalesce("chunks", F.expr(f"cast(array() as array<{CHUNK}>)")).alias("chunks")).alias("x"))
    ref = T.run_ref(F.col("model"), F.col("mode"), F.col("started_at"))
    r = runs.select("doc_id", "run_id", F.struct(ref.alias("ref"), "model", "mode", "status", T.iso(F.col("started_at")).alias("started_at"), T.iso(F.col("completed_at")).alias("completed_at"), "nodes_total", "nodes_completed", "nodes_failed", F.round("cost_estimate_usd", 6).alias("cost_usd")).alias("x"))
    keyed = questions.join(nodes.select("node_id", "sort_key"), "node_id").join(r.select("run_id", F.col("x.ref").alias("run_ref")), "run_id")
    q = keyed.select("doc_id", F.struct("run_ref", F.col("sort_key").alias("node_ref"), F.col("question_text").alias("question"), "justification", "status", "options").alias("x"), "generation_order")
    lists = documents
    for name, rows, kind in (("nodes", n, NODE), ("runs", r, RUN), ("questions", q, QUESTION)):
        grouped = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list("x")).alias(name))
        lists = lists.join(grouped, "doc_id", "left").withColumn(name, F.coalesce(F.col(name), F.expr(f"cast(array() as array<{kind}>)")))
    manual = F.struct("code", "edition", "title", "branch", "source_sha256")
    return lists.select(F.col("doc_id").cast("string").alias("bundle_id"), F.lit(1).alias("version"), T.iso(F.col("generated_at")).alias("generated_at"), manual.alias("manual"), "metadata", "nodes", "runs", "questions")


def as_json(bundles: DataFrame) -> DataFrame:
    """(bundle_id, json, sha256): explicit nulls, keys in the schema's order."""
    json = F.to_json(F.struct(*bundles.columns), {"ignoreNullFields": "false"})
    return bundles.select("bundle_id", json.alias("json")).withColumn("sha256", F.sha2("json", 256))


def write(bundles: DataFrame, path: str) -> None:
    """Bundles as JSON lines with their digests beside them, both under path."""
    rows = as_json(bundles)
    rows.select("json").write.mode("errorifexists").text(f"{path}/bundles", compression="gzip")
    rows.select("bundle_id", "sha256").write.mode("errorifexists").json(f"{path}/digests")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(f"{path}/bundles")


def verify(spark: SparkSession, path: str) -> DataFrame:
    """(bundle_id, state): ok, mismatch, or missing where a bundle has no digest."""
    lines = spark.read.text(f"{path}/bundles").select(F.get_json_object("value", "$.bundle_id").alias("bundle_id"), F.sha2("value", 256).alias("own"))
    said = spark.read.schema("bundle_id string, sha256 string").json(f"{path}/digests")
    return lines.join(said, "bundle_id", "left").select("bundle_id", F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") == F.col("own"), "ok").otherwise("mismatch").alias("state"))


def next_versions(files: DataFrame) -> DataFrame:
    """(slug, next_version) of file names {slug}--{day}--v{n}.json, gzipped or not: one more than the highest, whatever the day."""
    name = r"^([a-z0-9._-]+)--(\d{8})--v(\d+)\.json(?:\.gz)?$"
    found = files.select(F.regexp_extract("name", name, 1).alias("slug"), F.regexp_extract("name", name, 3).alias("v")).filter("slug != ''")
    return found.groupBy("slug").agg((F.max(F.col("v").cast("int")) + 1).alias("next_version"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size) of the files under a path, whatever they are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def with_source_digests(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Documents with the digest of their source file by name, null where it is gone."""
    name = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    known = files.groupBy(name(F.col("path")).alias("_name")).agg(F.min("sha256").alias("source_sha256"))
    return documents.drop("source_sha256").join(known, name(F.col("source_path")) == F.col("_name"), "left").drop("_name")
