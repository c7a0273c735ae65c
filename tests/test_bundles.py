"""A sound bundle, and one mutation a rule."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from folium.operators import validation
from folium.sources import bundles

NODE = {"ref": "01", "parent_ref": None, "level": 0, "level_label": "PARTE", "ordinal": "PRIMERA", "title": "La guerra", "page_start": 1, "page_end": 2, "chunks": [{"ordinal": 0, "text": "Texto", "page_start": 1, "page_end": 1}]}
CHILD = NODE | {"ref": "01.01", "parent_ref": "01", "level": 1, "level_label": "Capítulo", "chunks": []}
RUN = {"ref": "m--immediate--20240101T000000Z", "model": "m", "mode": "immediate", "status": "succeeded", "started_at": "2024-01-01T00:00:00Z", "completed_at": None, "nodes_total": 1, "nodes_completed": 1, "nodes_failed": 0, "cost_usd": 0.5}
OPTIONS = [{"order_in_question": i, "role": r, "text": f"opción {i}", "is_correct": r == "correct"} for i, r in enumerate(("correct", "confusa", "distractor", "distractor"))]
QUESTION = {"run_ref": RUN["ref"], "node_ref": "01", "question": "¿Qué?", "justification": "Porque", "status": "pending", "options": OPTIONS}
SOUND = {"bundle_id": "s", "version": 1, "generated_at": "2024-01-01T00:00:00Z", "manual": {"code": "A", "edition": None, "title": "T", "branch": None, "source_sha256": None}, "metadata": {"cost_input_tokens": "1234567890123"}, "nodes": [NODE, CHILD], "runs": [RUN], "questions": [QUESTION]}


def put(*path_and_value):
    *path, value = path_and_value

    def change(b):
        for k in path[:-1]:
            b = b[k]
        b[path[-1]] = value

    return change


def more(name, item):
    return lambda b: b[name].append(copy.deepcopy(item))


MUTATIONS = {
    "version": put("version", 99), "manual": put("manual", None), "manual_title": put("manual", "title", " "), "manual_code": put("manual", "code", "x" * 65), "manual_optional": put("manual", "edition", "x" * 65), "generated_at": put("generated_at", "ayer"), "lists": put("runs", None),
    "node_fields": put("nodes", 0, "level_label", ""), "node_numbers": put("nodes", 0, "level", -1), "node_ref_unique": more("nodes", CHILD), "chunk_fields": put("nodes", 0, "chunks", 0, "text", " "), "parent_exists": put("nodes", 1, "parent_ref", "77"),
    "chunk_ordinal_unique": lambda b: b["nodes"][0]["chunks"].append(b["nodes"][0]["chunks"][0]), "root": put("nodes", [CHILD | {"parent_ref": "01.01"}]), "cycle": lambda b: b["nodes"].extend([CHILD | {"ref": "a", "parent_ref": "b"}, CHILD | {"ref": "b", "parent_ref": "a"}]),
    "run_fields": put("runs", 0, "model", ""), "run_ref_unique": more("runs", RUN), "run_mode": put("runs", 0, "mode", "x"), "run_status": put("runs", 0, "status", "running"), "run_stamps": put("runs", 0, "started_at", "x"), "run_counters": put("runs", 0, "nodes_total", -1),
    "question_fields": put("questions", 0, "question", "x" * 1001), "question_status": put("questions", 0, "status", "x"), "four_options": put("questions", 0, "options", OPTIONS[:3]), "option_fields": put("questions", 0, "options", 3, "text", ""), "option_roles": put("questions", 0, "options", 3, "role", "confusa"),
    "option_correct": put("questions", 0, "options", 1, "is_correct", True), "option_texts": put("questions", 0, "options", 3, "text", " OPCIÓN   2"), "option_order": put("questions", 0, "options", 3, "order_in_question", 2),
    "node_exists": put("questions", 0, "node_ref", "77"), "run_exists": put("questions", 0, "run_ref", "77"), "pair_unique": more("questions", QUESTION), "name": put("metadata", "api_key", "x" * 12), "connection_string": put("metadata", "a", "postgres://u:p@h"), "google_key": put("metadata", "a", "AIza" + "x" * 20), "openai_key": put("metadata", "a", "sk-" + "x" * 20), "private_key": put("metadata", "a", "-----BEGIN RSA PRIVATE KEY-----"),
}


def frame(spark, items):
    lines = [(json.dumps(x, ensure_ascii=False),) for x in items]
    return spark.createDataFrame(lines, "j string").select(F.from_json("j", bundles.SCHEMA).alias("b")).select("b.*")


@pytest.fixture(scope="module")
def found(spark):
    items = [SOUND]
    for name, change in MUTATIONS.items():
        b = copy.deepcopy(SOUND) | {"bundle_id": name}
        change(b)
        items.append(b)
    rows = validation.errors(frame(spark, items)).collect()
    out = {}
    for r in rows:
        out.setdefault(r["bundle_id"], set()).add(r["rule"])
    return out


def test_sound(found):
    assert "s" not in found


@pytest.mark.parametrize("rule", MUTATIONS)
def test_each_rule(found, rule):
    assert rule in found[rule]


def test_warnings_and_counts(spark):
    empty = copy.deepcopy(SOUND) | {"bundle_id": "e", "questions": []}
    rejected = copy.deepcopy(SOUND) | {"bundle_id": "r"}
    rejected["questions"][0]["status"] = "rejected"
    rejected["runs"][0]["nodes_failed"] = 2
    items = frame(spark, [SOUND, empty, rejected])
    got = sorted((r["bundle_id"], r["rule"]) for r in validation.warnings(items).collect())
    assert got == [("e", "no_questions"), ("e", "uncovered"), ("r", "failed_nodes"), ("r", "none_served"), ("r", "unserved_status")]
    counts = {r["bundle_id"]: (r["nodes"], r["chunks"], r["runs"], r["questions"], r["served"], r["status_rejected"]) for r in validation.counts(items).collect()}
    assert counts == {"s": (2, 1, 1, 1, 1, 0), "e": (2, 1, 1, 0, 0, 0), "r": (2, 1, 1, 1, 0, 1)}


def test_round_trip_and_digests(spark, tmp_path):
    path = f"file://{tmp_path}/b"
    items = frame(spark, [SOUND, SOUND | {"bundle_id": "t"}])
    bundles.write(items, path)
    assert sorted(map(repr, bundles.read(spark, path).collect())) == sorted(map(repr, items.collect()))
    assert {(r["bundle_id"], r["state"]) for r in bundles.verify(spark, path).collect()} == {("s", "ok"), ("t", "ok")}
    spark.createDataFrame([("s", "0" * 64)], "bundle_id string, sha256 string").write.mode("overwrite").json(f"{path}/digests")
    assert {(r["bundle_id"], r["state"]) for r in bundles.verify(spark, path).collect()} == {("s", "mismatch"), ("t", "missing")}


def test_build_is_stable(spark):
    documents = spark.createDataFrame([(1, "A", None, "T", None, None, {"k": "v"})], "doc_id long, code string, edition string, title string, branch string, source_sha256 string, metadata map<string,string>").withColumn("generated_at", F.expr("timestamp'2024-01-01 00:00:00'"))
    nodes = spark.createDataFrame([(1, 10, "01", None, 0, "PARTE", "I", "x", 1, 2), (1, 11, "01.01", "01", 1, "Capítulo", "I", "y", 1, 2)], "doc_id long, node_id long, sort_key string, parent_key string, level int, level_label string, ordinal string, title string, page_start int, page_end int")
    chunks = spark.createDataFrame([(10, 1, "b", 1, 1), (10, 0, "a", 1, 1)], "node_id long, ordinal int, text string, page_start int, page_end int")
    runs = spark.createDataFrame([(1, 5, "m", "immediate", "succeeded", 1, 1, 0, 0.1234567)], "doc_id long, run_id long, model string, mode string, status string, nodes_total int, nodes_completed int, nodes_failed int, cost_estimate_usd double").withColumns({"started_at": F.expr("timestamp'2024-01-01 00:00:00'"), "completed_at": F.lit(None).cast("timestamp")})
    questions = spark.createDataFrame([(1, 5, 10, "¿?", "j", "pending", 0, [(i, o["role"], o["text"], o["is_correct"]) for i, o in enumerate(OPTIONS)])], f"doc_id long, run_id long, node_id long, question_text string, justification string, status string, generation_order int, options array<{bundles.OPTION}>")
    built = bundles.build(documents, nodes, chunks, runs, questions)
    again = bundles.build(documents, nodes.orderBy(F.desc("node_id")), chunks.orderBy("ordinal"), runs, questions)
    assert bundles.as_json(built).first()["sha256"] == bundles.as_json(again).first()["sha256"]
    assert validation.errors(built).count() == 0 and '"edition":null' in bundles.as_json(built).first()["json"]
    row = built.first()
    assert [c["text"] for c in row["nodes"][0]["chunks"]] == ["a", "b"] and row["runs"][0]["cost_usd"] == 0.123457


def test_cycles_stamps_and_secrets_anywhere(spark):
    looped = copy.deepcopy(SOUND) | {"bundle_id": "loop"}
    looped["nodes"][0]["parent_ref"] = looped["nodes"][1]["ref"]
    looped["nodes"][1]["parent_ref"] = looped["nodes"][0]["ref"]
    offset = copy.deepcopy(SOUND) | {"bundle_id": "offset", "generated_at": "2024-01-01T00:00:00+02:00"}
    hidden = copy.deepcopy(SOUND) | {"bundle_id": "hidden"}
    hidden["nodes"][0]["title"] = "sk-abcdefghijklmnopqrstuvwx"
    hidden["questions"][0]["options"][1]["text"] = "AIzaSyA1234567890abcdefghij"
    items = frame(spark, [SOUND, looped, offset, hidden])
    got = {(r["bundle_id"], r["path"], r["rule"]) for r in validation.errors(items).collect()}
    assert {("loop", "$.nodes", "cycle"), ("offset", "$", "generated_at"), ("hidden", "$.nodes[0].title", "openai_key"), ("hidden", "$.questions[0].options[1].text", "google_key")} <= got
    assert not any(b == "s" for b, _, _ in got)
    nodes = spark.createDataFrame([("b", "1", None), ("b", "2", "1"), ("b", "3", "4"), ("b", "4", "3"), ("b", "5", "3"), ("b", "6", "gone"), ("c", "1", "1")], "bundle_id string, ref string, parent_ref string")
    assert sorted(map(tuple, validation.cycles(nodes).collect())) == [("b", "3"), ("b", "4"), ("b", "5"), ("c", "1")]
