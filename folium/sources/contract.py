"""Bundles by the delivery contract, version 1: one JSON document with everything a receiver needs.

The text is put together from the parts' own JSON, since free metadata has no schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions import text as T

# The contract's version, and the catalogue entries suggested by how a document's code begins.
VERSION = 1
GRADE_HINT, SUBJECT_HINTS, SUBJECT_HINT = "SARG_2", {"CJM": "JUS_MIL"}, "OPS_MIL"
TOOL, TOOL_VERSION = "folium", "1"


def _json(**fields: Column) -> Column:
    """An object of scalars, nulls written out."""
    return F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())), {"ignoreNullFields": "false"})


def _with(scalars: Column, **texts: Column) -> Column:
    """An object with further fields whose values are JSON texts, behind its own."""
    return F.concat(F.substring(scalars, F.lit(1), F.length(scalars) - 1), *(F.concat(F.lit(f',"{k}":'), v) for k, v in texts.items()), F.lit("}"))


def _joined(first: Column, second: Column) -> Column:
    """One object of the fields of two."""
    return F.concat(F.substring(first, F.lit(1), F.length(first) - 1), F.lit(","), F.substring(second, F.lit(2), F.length(second) - 1))


def _free(df: DataFrame, column: str) -> Column:
    """A free JSON object by its text; {} where the column or the text is missing or can't be parsed."""
    if column not in df.columns:
        return F.lit("{}")
    parsed = F.try_parse_json(column)
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed)).otherwise("{}")


def _given(df: DataFrame, column: str, default: Column) -> Column:
    return F.col(column) if column in df.columns else default


def _list(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """(key, name): the rows' JSON as one JSON list, in order."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(*order, "json")))
    return rows.groupBy(key).agg(F.concat(F.lit("["), F.array_join(F.transform(sorted_rows, lambda x: x["json"]), ","), F.lit("]")).alias(name))


def build(documents: DataFrame, nodes: DataFrame, chunks: DataFrame, runs: DataFrame, questions: DataFrame, options: DataFrame, include_raw: bool = False) -> DataFrame:
    """(bundle_id, code, generated_at, json), one row a document; equal stores give equal texts.

    documents: doc_id, code, edition, title, branch, source_path, source_sha256, page_count, extractor, ingested_at,
    generated_at, metadata_json. nodes: node_id, doc_id, sort_key, parent_id, level, level_label, ordinal, title,
    breadcrumb, page_start, page_end, is_anexo. chunks: node_id, ordinal, text, char_count, page_start, page_end,
    has_table, has_image_ref. runs: run_id, doc_id, model, mode, status, started_at, completed_at, counters, tokens
    and cost_estimate_usd, profile_used, rules_json. questions: question_id, run_id, node_id, generation_order,
    question_text, justification, status, validated_at, created_at. options: question_id, order_in_question, role,
    text, is_correct. metadata_json of any table, where it has that column, is carried as an object; a question's
    raw_response_json only with include_raw. Sections are in the order of their keys, chunks and options of their
    ordinals, runs of their ids, questions by run, order and id.
    """
    text, zero, false = F.lit(None).cast("string"), F.lit(0), F.lit(False)
    c = chunks.select("node_id", F.col("ordinal").cast("int").alias("ordinal"), _with(_json(ordinal=F.col("ordinal").cast("int"), text=F.col("text"), char_count=F.col("char_count"), page_start=F.col("page_start"), page_end=F.col("page_end"), has_table=F.coalesce("has_table", false), has_image_ref=F.coalesce("has_image_ref", false)), metadata=_free(chunks, "metadata_json")).alias("json"))
    refs = nodes.select("node_id", F.col("sort_key").alias("node_ref"))
    n = nodes.join(_list(c, "node_id", ["ordinal"], "chunks"), "node_id", "left").join(refs.toDF("parent_id", "parent_ref"), "parent_id", "left")
    body = _json(ref=F.col("sort_key"), parent_ref=F.col("parent_ref"), level=F.col("level"), level_label=F.col("level_label"), ordinal=F.col("ordinal"), title=F.col("title"), breadcrumb=F.col("breadcrumb"), page_start=F.col("page_start"), page_end=F.col("page_end"), is_anexo=F.coalesce("is_anexo", false))
    n = n.select("doc_id", "sort_key", "node_id", _with(body, metadata=_free(n, "metadata_json"), chunks=F.coalesce("chunks", F.lit("[]"))).alias("json"))

    ref = T.run_ref(F.col("model"), F.col("mode"), F.col("started_at"))
    body = _json(ref=ref, model=F.col("model"), mode=F.col("mode"), status=F.col("status"), profile_used=_given(runs, "profile_used", F.lit("manual")))
    tail = _json(started_at=T.iso(F.col("started_at")), completed_at=T.iso(F.col("completed_at")), nodes_total=F.col("nodes_total"), nodes_completed=F.col("nodes_completed"), nodes_failed=F.col("nodes_failed"), cost_input_tokens=_given(runs, "cost_input_tokens", zero), cost_output_tokens=_given(runs, "cost_output_tokens", zero), cost_cached_tokens=_given(runs, "cost_cached_tokens", zero), cost_estimate_usd=F.round(F.coalesce("cost_estimate_usd", F.lit(0.0)), 6))
    r = runs.select("doc_id", "run_id", ref.alias("run_ref"), _with(_joined(_with(body, rules_snapshot=_free(runs, "rules_json")), tail), metadata=_free(runs, "metadata_json")).alias("json"))

    o = options.select("question_id", "order_in_question", _with(_json(role=F.col("role"), order_in_question=F.col("order_in_question"), text=F.col("text"), is_correct=F.coalesce("is_correct", false)), metadata=_free(options, "metadata_json")).alias("json"))
    q = questions.drop("doc_id").join(_list(o, "question_id", ["order_in_question"], "options"), "question_id", "left").join(refs, "node_id").join(r.select("run_id", "doc_id", "run_ref"), "run_id")
    body = _json(run_ref=F.col("run_ref"), node_ref=F.col("node_ref"), generation_order=F.col("generation_order"), question_text=F.col("question_text"), justification=F.col("justification"), validation_status=F.coalesce(_given(q, "status", text), F.lit("pending")), validated_at=T.iso(_given(q, "validated_at", F.lit(None).cast("timestamp"))), created_at=T.iso(F.col("created_at")))
    raw = {"raw_response": _free(q, "raw_response_json")} if include_raw else {}
    q = q.select("doc_id", "run_id", "generation_order", "question_id", _with(body, metadata=_free(q, "metadata_json"), **raw, options=F.coalesce("options", F.lit("[]"))).alias("json"))

    rows = documents
    for name, part, order in (("nodes", n, ["sort_key", "node_id"]), ("runs", r.select("doc_id", "run_id", "json"), ["run_id"]), ("questions", q, ["run_id", "generation_order", "question_id"])):
        rows = rows.join(_list(part, "doc_id", order, name), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit("[]")))
    head = _json(bundle_version=F.lit(VERSION), generated_at=T.iso(F.col("generated_at")))
    maker = _json(tool=F.lit(TOOL), version=F.lit(TOOL_VERSION), pipeline_commit=text)
    manual = _json(code=F.col("code"), edition=F.col("edition"), title=F.col("title"), branch=F.col("branch"), source_path=F.col("source_path"), source_sha256=_given(documents, "source_sha256", text), page_count=F.col("page_count"), extractor_used=F.col("extractor"), ingested_at=T.iso(F.col("ingested_at")))
    subject = F.lit(SUBJECT_HINT)
    for begins, hint in SUBJECT_HINTS.items():
        subject = F.when(F.upper("code").startswith(begins), hint).otherwise(subject)
    whole = _with(head, generator=maker, manual=_with(manual, metadata=_free(documents, "metadata_json")), catalog_hint=_json(grado_code=F.lit(GRADE_HINT), materia_code=subject), nodes=F.col("nodes"), runs=F.col("runs"), questions=F.col("questions"))
    return rows.select(F.col("doc_id").cast("string").alias("bundle_id"), "code", "generated_at", whole.alias("json"))
