"""Asking models: kept answers, threads, instructions, and whole runs."""

import json
import os

import pytest
from pyspark.sql import functions as F
from test_structure import MANUAL, frame

from folium.operators import generation, rules
from folium.plans import ingest, questions
from folium.sources.store import Store


def answers_of(folder):
    return sorted(x.split("-")[0] for x in os.listdir(folder))


def test_a_killed_job_asks_only_for_the_rest(spark, tmp_path):
    asked, path = tmp_path / "asked", f"file://{tmp_path}/kept"
    asked.mkdir()

    def client(prompt):
        (asked / f"{prompt}-{os.getpid()}-{os.urandom(4).hex()}").touch()
        if prompt == "p25" and not (tmp_path / "mended").exists():
            os._exit(1)
        return {"text": prompt.upper(), "input_tokens": 1, "output_tokens": 2, "error": None}

    prompts = spark.range(30).select(F.col("id").alias("key"), F.concat(F.lit("p"), "id").alias("prompt")).repartitionByRange(1, "key").sortWithinPartitions("key")
    with pytest.raises(Exception):
        generation.answer(prompts, path, client, per_round=10, threads=2)
    before = answers_of(asked)
    (tmp_path / "mended").touch()
    got = generation.answer(prompts, path, client, per_round=10, threads=2)
    assert sorted((r["key"], r["response"]) for r in got.collect()) == sorted((k, f"P{k}") for k in range(30))
    again = answers_of(asked)
    for x in before:
        again.remove(x)
    # at most the round that was broken off is asked for again
    assert len(again) <= 30 - 10 * (len(set(before) - {"p25"}) // 10) and set(before) | set(again) == {f"p{k}" for k in range(30)}
    assert generation.answer(prompts, path, client, per_round=10).count() == 30 and len(answers_of(asked)) == len(before) + len(again)


def test_threads_keep_order_and_errors(spark):
    def client(prompt):
        if prompt == "bad":
            raise ValueError("no")
        return generation.stub_client(prompt)

    rows = spark.createDataFrame([(k, "bad" if k % 3 == 0 else f"text {k}") for k in range(20)] + [(99, None)], "key long, prompt string")
    got = {r["key"]: r for r in generation.generate(rows, client, threads=4).collect()}
    assert len(got) == 21 and got[0]["error"] == "ValueError: no" and got[4]["response"] == "¿text 4?" and got[99]["error"] == "empty prompt"


def test_instructions(spark):
    told = rules.table(spark).filter("name = 'manual'").withColumn("extra_instructions", F.lit("Sin siglas."))
    creator, solver = told.select(generation.creator_instructions(), generation.solver_instructions(F.lit("¿Qué?"))).first()
    assert "definiciones, principios" in creator and "fechas de edición" in creator and '{"questions"' in creator and "manual" in creator
    assert solver.endswith("Pregunta: ¿Qué?") and "Sin siglas." in solver and "Una idea por pregunta." in solver and '"role": "correct"' in solver
    bare = told.withColumns({"preferred_topics": F.array().cast("array<string>"), "style_guide": F.lit("")})
    assert "Temas preferentes: (ninguno)" in bare.select(generation.creator_instructions()).first()[0]


def test_suggestions_and_solutions(spark):
    rows = [(1, '{"questions": [" ¿Uno? A) no", "", "¿Dos?"]}', None), (2, "no json", None), (3, '{"questions": "x"}', None), (4, '{"questions": ["¿x?"]}', "failed"), (5, None, None), (6, json.dumps({"questions": [f"¿{k}?" for k in range(9)]}), None)]
    frame = spark.createDataFrame(rows, "key long, response string, error string")
    got = [(r["key"], r["draft"], r["question"]) for r in generation.suggested(frame).orderBy("key", "draft").collect()]
    assert got == [(1, 0, "¿Uno?"), (1, 2, "¿Dos?"), *((6, k, f"¿{k}?") for k in range(5))]
    one = json.dumps({"question_text": "q", "justification": "j", "options": [{"role": "correct", "text": "t"}]})
    rows = [("1:0", one, None), ("1:1", "{}", None), ("1:2", one, "x"), ("1:3", "[]", None)]
    assert [r["key"] for r in generation.solved(spark.createDataFrame(rows, "key string, response string, error string")).collect()] == ["1:0"]


def test_a_whole_run(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store").create()
    documents = spark.createDataFrame([(7, "A", 5, json.dumps({"profile": "manual", "question_rules": {"style_guide": "ESTILO"}}))], "doc_id long, code string, page_count int, metadata_json string")
    for c, kind in (("title", "string"), ("edition", "string"), ("branch", "string"), ("source_path", "string"), ("extractor", "string"), ("ingested_at", "timestamp")):
        documents = documents.withColumn(c, F.lit(None).cast(kind))
    ingest.run(store, documents, frame(spark, MANUAL, 7)).collect()

    def client(prompt):
        if "¿mala?" in prompt and "Pregunta:" in prompt:
            body = {"question_text": "¿mala?", "justification": "j", "options": []}
        elif "Pregunta:" in prompt:
            assert "ESTILO" in prompt
            literal = prompt.strip().splitlines()[-1] if "¿buena?" in prompt else "nada de eso"
            body = {"question_text": "¿buena? A) x" if "¿buena?" in prompt else "¿dudosa?", "justification": "j", "options": [{"role": r, "text": t} for r, t in (("correct", literal), ("confusa", "b"), ("distractor", "c"), ("distractor", "d"))]}
        else:
            body = {"questions": ["¿buena? B) y", "¿dudosa?", "¿mala?"]}
        return {"text": json.dumps(body), "input_tokens": 1000, "output_tokens": 100, "error": None}

    done = questions.run(store, 3, f"file://{tmp_path}/run", client, "flash", threads=2).collect()
    nodes = store.table("nodes").join(store.table("chunks").select("node_id").distinct(), "node_id", "left_semi").filter("not title ilike '%introducci%'").count()
    assert nodes > 0 and [(r["status"], r["nodes_total"], r["nodes_completed"], r["nodes_failed"], r["model"]) for r in done] == [("partial", nodes, 2 * nodes, nodes, "gemini-2.5-flash")]
    assert done[0]["cost_estimate_usd"] == pytest.approx(4 * nodes * (1000 * 0.3 + 100 * 2.5) / 1e6, abs=1e-6)
    saved = store.questions().collect()
    assert sorted((r["question_text"], r["status"]) for r in saved) == sorted([("¿buena?", "pending"), ("¿dudosa?", "needs_review")] * nodes)
    assert sorted(r["generation_order"] for r in saved) == list(range(1, 2 * nodes + 1)) and store.table("options").count() == 8 * nodes
    # nothing is left to ask for
    assert questions.run(store, 4, f"file://{tmp_path}/run4", client).collect()[0]["nodes_total"] == 0
