"""Export of bundles: build, check, write. Nothing is written unless everything is sound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium import shared
from folium.operators import contract_checks, validation
from folium.sources import bundle_files, bundles, contract


class Unsound(ValueError):
    """A bundle broke rules; `errors` has the first of them."""

    def __init__(self, errors: list):
        super().__init__("; ".join(f"{e['bundle_id']} {e['path']}: {e['message']}" for e in errors))
        self.errors = errors


def missing_runs(requested: DataFrame, runs: DataFrame) -> DataFrame:
    """Requested run ids that the store doesn't have."""
    return requested.select("run_id").distinct().join(runs.select("run_id"), "run_id", "left_anti")


def repeated_keys(nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, key) that stand for two sections or runs of a document, which no bundle can hold."""
    n = nodes.groupBy("doc_id", F.col("sort_key").alias("key")).count()
    r = runs.groupBy("doc_id", F.concat_ws("--", "model", "mode", F.date_format("started_at", "yyyyMMdd'T'HHmmss'Z'")).alias("key")).count()
    return n.unionByName(r).filter("count > 1").select("doc_id", "key")


def source_errors(nodes: DataFrame, runs: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """What makes an export impossible before bundles are built: requested runs that are not there, and repeated keys."""
    twice = repeated_keys(nodes, runs).select(F.col("doc_id").cast("string").alias("bundle_id"), F.col("key").alias("path"), F.lit("repeated_key").alias("rule"), F.lit("two sections or runs have this key").alias("message"))
    if requested is None:
        return twice
    gone = missing_runs(requested, runs).select(F.lit("").alias("bundle_id"), F.col("run_id").cast("string").alias("path"), F.lit("missing_run").alias("rule"), F.lit("the store has no such run").alias("message"))
    return twice.unionByName(gone)


def export_store(documents: DataFrame, nodes: DataFrame, chunks: DataFrame, runs: DataFrame, questions: DataFrame, options: DataFrame, path: str | None, requested: DataFrame | None = None, include_raw: bool = False) -> DataFrame:
    """Build the contract's bundles of a store's tables and deliver them; with `requested` (run_id) only those runs' questions."""
    errors = source_errors(nodes, runs, requested)
    if requested is not None:
        runs = runs.join(requested.select("run_id").distinct(), "run_id", "left_semi")
        questions = questions.join(requested.select("run_id").distinct(), "run_id", "left_semi")
    return deliver(contract.build(documents, nodes, chunks, runs, questions, options, include_raw), path, before=errors)


def deliver(built: DataFrame, path: str | None, shown: int = 20, before: DataFrame | None = None, gzip_bytes: int = bundle_files.GZIP_BYTES) -> DataFrame:
    """Write bundles (bundle_id, code, generated_at, json) as files under path (None: only check them); returns their warnings.

    The bundles are built once and kept; what is checked is what is written, all of it or nothing. Raises Unsound with
    the first errors; `before` has errors found in what the bundles were built from.
    """
    spark = built.sparkSession
    errors = before.orderBy("bundle_id", "path").limit(shown).collect() if before is not None else []
    if errors:
        raise Unsound(errors)
    built, at = shared.stored(built)
    try:
        errors = contract_checks.errors(built).orderBy("bundle_id", "path", "rule").limit(shown).collect()
        if errors:
            raise Unsound(errors)
        if path is not None:
            bundle_files.write(bundle_files.versioned(built, bundle_files.names(spark, path)), path, gzip_bytes)
        return shared.stored(contract_checks.warnings(built))[0]
    finally:
        shared.delete(spark, at)


def export(built: DataFrame, path: str | None, shown: int = 20, before: DataFrame | None = None) -> DataFrame:
    """Write bundles to path (None: only check them); returns their warnings. Raises Unsound with the first errors.

    `before` has errors found in what the bundles were built from.
    """
    errors = before.orderBy("bundle_id", "path").limit(shown).collect() if before is not None else []
    errors = errors or validation.errors(built).orderBy("bundle_id", "path", "rule").limit(shown).collect()
    if errors:
        raise Unsound(errors)
    if path is not None:
        bundles.write(built, path)
    return validation.warnings(built)
