"""The delivery contract: what is built, checked, written and read again."""

import copy
import gzip
import json
import os
import pickle

import pytest
from pyspark.sql import functions as F

from folium.operators import contract_checks, validation
from folium.plans import export
from folium.sources import bundle_files, contract

CHUNK = {"ordinal": 0, "text": "Texto", "char_count": 5, "page_start": 1, "page_end": 1, "has_table": False, "has_image_ref": False, "metadata": {}}
NODE = {"ref": "01", "parent_ref": None, "level": 0, "level_label": "PARTE", "ordinal": "PRIMERA", "title": "La guerra", "breadcrumb": "PARTE PRIMERA", "page_start": 1, "page_end": 2, "is_anexo": False, "metadata": {}, "chunks": [CHUNK]}
CHILD = NODE | {"ref": "01.01", "parent_ref": "01", "level": 1, "chunks": []}
RUN = {"ref": "m--batch--20240101T000000Z", "model": "m", "mode": "batch", "status": "succeeded", "profile_used": "manual", "rules_snapshot": {}, "started_at": "2024-01-01T00:00:00Z", "completed_at": None, "nodes_total": 1, "nodes_completed": 1, "nodes_failed": 0, "cost_input_tokens": 12345678901234567890, "cost_output_tokens": 0, "cost_cached_tokens": 0, "cost_estimate_usd": 0.5, "metadata": {}}
OPTIONS = [{"role": r, "order_in_question": k, "text": f"opción {k}", "is_correct": r == "correct", "metadata": {}} for k, r in enumerate(("correct", "confusa", "distractor", "distractor"))]
QUESTION = {"run_ref": RUN["ref"], "node_ref": "01", "generation_order": 0, "question_text": "¿Qué?", "justification": "Porque", "validation_status": "pending", "validated_at": None, "created_at": "2024-01-01T00:00:00Z", "metadata": {}, "options": OPTIONS}
SOUND = {
    "bundle_version": 1, "generated_at": "2024-01-01T00:00:00.5Z", "generator": {"tool": "t", "version": "1", "pipeline_commit": None},
    "manual": {"code": "A", "edition": None, "title": "T", "branch": None, "source_path": "a.pdf", "source_sha256": None, "page_count": 3, "extractor_used": "docling", "ingested_at": "2024-01-01T00:00:00Z", "metadata": {"cost_input_tokens": "a token counter, no secret"}},
    "catalog_hint": {"grado_code": "G", "materia_code": None}, "nodes": [NODE, CHILD], "runs": [RUN], "questions": [QUESTION],
}


def at(path, value):
    """A change of one place; `...` takes the field away."""

    def change(b):
        for k in path[:-1]:
            b = b[k]
        if value is ...:
            del b[path[-1]]
        else:
            b[path[-1]] = value

    return change


def more(name, item):
    return lambda b: b[name].append(copy.deepcopy(item))


#: One change a case, and what it must give: (path, rule).
CASES = [
    (at(["bundle_version"], 99), "$.bundle_version version"), (at(["bundle_version"], "1"), "$.bundle_version version"), (at(["bundle_version"], ...), "$.bundle_version version"),
    (at(["generated_at"], "ayer"), "$.generated_at stamp"), (at(["generated_at"], 5), "$.generated_at stamp"), (at(["generated_at"], "2024-01-01T00:00:00+02:00"), "$.generated_at stamp"), (at(["generated_at"], ...), "$.generated_at missing"),
    (at(["generator"], None), "$.generator object"), (at(["generator"], "qgen"), "$.generator object"), (at(["generator", "tool"], 7), "$.generator.tool type"), (at(["generator", "version"], " "), "$.generator.version blank"),
    (at(["manual"], ...), "$.manual object"), (at(["manual", "title"], ...), "$.manual.title missing"), (at(["manual", "title"], 3), "$.manual.title type"), (at(["manual", "title"], " \n"), "$.manual.title blank"), (at(["manual", "code"], "x" * 65), "$.manual.code length"),
    (at(["manual", "source_path"], False), "$.manual.source_path type"), (at(["manual", "extractor_used"], None), "$.manual.extractor_used missing"), (at(["manual", "page_count"], "3"), "$.manual.page_count type"), (at(["manual", "page_count"], True), "$.manual.page_count type"),
    (at(["manual", "page_count"], 3.0), "$.manual.page_count type"), (at(["manual", "page_count"], -1), "$.manual.page_count range"), (at(["manual", "ingested_at"], None), "$.manual.ingested_at missing"), (at(["manual", "metadata"], []), "$.manual.metadata object"), (at(["manual", "edition"], 5), "$.manual.edition type"),
    (at(["catalog_hint"], []), "$.catalog_hint object"), (at(["catalog_hint", "materia_code"], 5), "$.catalog_hint.materia_code type"), (at(["nodes"], {}), "$.nodes list"), (at(["runs"], ...), "$.runs list"), (at(["questions"], "x"), "$.questions list"),
    (at(["nodes", 1], 5), "$.nodes[1] object"), (at(["nodes", 0, "level"], -1), "$.nodes[0].level range"), (at(["nodes", 0, "level"], 0.5), "$.nodes[0].level type"), (at(["nodes", 0, "level_label"], ""), "$.nodes[0].level_label blank"), (at(["nodes", 0, "ordinal"], ...), "$.nodes[0].ordinal missing"),
    (at(["nodes", 1, "title"], "x" * 1025), "$.nodes[1].title length"), (at(["nodes", 1, "is_anexo"], 0), "$.nodes[1].is_anexo type"), (at(["nodes", 1, "is_anexo"], ...), "$.nodes[1].is_anexo type"), (at(["nodes", 1, "parent_ref"], 1), "$.nodes[1].parent_ref type"), (at(["nodes", 1, "chunks"], None), "$.nodes[1].chunks list"),
    (at(["nodes", 1, "page_end"], "2"), "$.nodes[1].page_end type"), (at(["nodes", 0, "chunks", 0], []), "$.nodes[0].chunks[0] object"), (at(["nodes", 0, "chunks", 0, "text"], " "), "$.nodes[0].chunks[0].text blank"), (at(["nodes", 0, "chunks", 0, "char_count"], "5"), "$.nodes[0].chunks[0].char_count type"),
    (at(["nodes", 0, "chunks"], [CHUNK, CHUNK | {"ordinal": 1}, CHUNK]), "$.nodes[0].chunks[2].ordinal unique"), (more("nodes", CHILD), "$.nodes[2].ref unique"), (at(["nodes", 1, "parent_ref"], "77"), "$.nodes[1].parent_ref reference"), (at(["nodes", 0, "parent_ref"], "01.01"), "$.nodes root,$.nodes cycle"),
    (lambda b: b["nodes"].extend([CHILD | {"ref": "a", "parent_ref": "b"}, CHILD | {"ref": "b", "parent_ref": "a"}]), "$.nodes cycle"),
    (at(["runs", 0, "mode"], "x"), "$.runs[0].mode enum"), (at(["runs", 0, "mode"], 1), "$.runs[0].mode enum"), (at(["runs", 0, "status"], "running"), "$.runs[0].status running"), (at(["runs", 0, "status"], ...), "$.runs[0].status enum"), (at(["runs", 0, "started_at"], ...), "$.runs[0].started_at missing"),
    (at(["runs", 0, "cost_estimate_usd"], "1"), "$.runs[0].cost_estimate_usd number"), (at(["runs", 0, "cost_estimate_usd"], -0.1), "$.runs[0].cost_estimate_usd number"), (at(["runs", 0, "cost_estimate_usd"], True), "$.runs[0].cost_estimate_usd number"), (at(["runs", 0, "nodes_total"], ...), "$.runs[0].nodes_total missing"),
    (at(["runs", 0, "profile_used"], "x" * 33), "$.runs[0].profile_used length"), (at(["runs", 0, "rules_snapshot"], "x"), "$.runs[0].rules_snapshot object"), (more("runs", RUN), "$.runs[1].ref unique"),
    (at(["questions", 0, "question_text"], "x" * 1001), "$.questions[0].question_text length"), (at(["questions", 0, "validation_status"], None), "$.questions[0].validation_status enum"), (at(["questions", 0, "node_ref"], "77"), "$.questions[0].node_ref reference"), (at(["questions", 0, "run_ref"], "77"), "$.questions[0].run_ref reference"),
    (more("questions", QUESTION), "$.questions[1] unique"), (at(["questions", 0, "options"], 3), "$.questions[0].options list"), (at(["questions", 0, "options", 3, "role"], "confusa"), "$.questions[0] roles"), (at(["questions", 0, "options", 1, "is_correct"], True), "$.questions[0] correct"),
    (at(["questions", 0, "options", 0, "is_correct"], False), "$.questions[0] correct"), (at(["questions", 0, "options", 3, "text"], " OPCIÓN \t 2"), "$.questions[0] same_text"), (at(["questions", 0, "options", 3, "order_in_question"], 2), "$.questions[0] same_place"),
    (at(["questions", 0, "options", 3, "is_correct"], "no"), "$.questions[0].options[3].is_correct type"), (at(["questions", 0, "options"], OPTIONS[:3]), "$.questions[0] four_options,$.questions[0] roles"),
    (at(["manual", "metadata", "api_key"], "x" * 12), "$.manual.metadata.api_key secret"), (at(["runs", 0, "metadata"], {"a": [{"b": "x\nsk-" + "x" * 20}]}), "$.runs[0].metadata.a[0].b secret"), (at(["nodes", 0, "chunks", 0, "text"], "postgres://u:p@h"), "$.nodes[0].chunks[0].text secret"),
    (at(["runs", 0, "rules_snapshot"], {"password": 12345678901234, "token": "short", "Tokens": ["a long enough text"]}), "$.runs[0].rules_snapshot.Tokens[0] secret"), (at(["extra"], {"x": "AIza" + "x" * 20}), "$.extra.x secret"),
    (at(["manual", "metadata", "pem"], "-----BEGIN RSA PRIVATE KEY-----"), "$.manual.metadata.pem secret"), (at(["manual", "metadata", "cost_input_tokens"], 5), ""), (at(["unknown"], 5), ""), (at(["nodes", 0, "page_end"], ...), ""), (at(["catalog_hint"], ...), ""),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [("sound", json.dumps(SOUND)), ("null", None), ("text", "no json"), ("list", "[1]")]
    for k, (change, _) in enumerate(CASES):
        bundle = copy.deepcopy(SOUND)
        change(bundle)
        rows.append((str(k), json.dumps(bundle, ensure_ascii=bool(k % 2))))
    out = {}
    for r in contract_checks.errors(spark.createDataFrame(rows, "bundle_id string, json string").repartition(4)).collect():
        assert r["message"]
        out.setdefault(r["bundle_id"], []).append(f"{r['path']} {r['rule']}")
    return out


def test_sound_bundles_and_other_texts(found):
    assert "sound" not in found and all(found[k] == ["$ json"] for k in ("null", "text", "list"))


@pytest.mark.parametrize("k", range(len(CASES)))
def test_each_rule(found, k):
    assert sorted(found.get(str(k), [])) == sorted(x for x in CASES[k][1].split(",") if x)


def test_no_bundles(spark):
    none = spark.createDataFrame([], "bundle_id string, json string")
    assert contract_checks.errors(none).count() == contract_checks.warnings(none).count() == contract_checks.counts(none).count() == 0


def test_warnings_and_counts(spark):
    bundle = copy.deepcopy(SOUND)
    bundle["runs"][0]["nodes_failed"] = 2
    bundle["questions"] = [QUESTION | {"validation_status": s, "node_ref": n} for s, n in (("rejected", "01.01"), ("needs_review", "x"), ("rejected", "y"))]
    empty = copy.deepcopy(SOUND) | {"questions": [], "runs": []}
    rows = spark.createDataFrame([("a", json.dumps(bundle)), ("b", json.dumps(empty)), ("c", json.dumps(SOUND))], "bundle_id string, json string")
    got = sorted(tuple(r) for r in contract_checks.warnings(rows).collect())
    assert got == [("a", "failed_nodes", 1), ("a", "none_served", 1), ("a", "uncovered", 1), ("a", "unserved_needs_review", 1), ("a", "unserved_rejected", 2), ("b", "no_questions", 1), ("b", "uncovered", 1)]
    counted = {r["bundle_id"]: r.asDict() for r in contract_checks.counts(rows).collect()}
    assert counted["a"] == {"bundle_id": "a", "nodes": 2, "chunks": 1, "runs": 1, "questions": 3, "served": 0, "status_pending": 0, "status_valid": 0, "status_needs_review": 1, "status_rejected": 2}
    assert counted["c"]["served"] == 1


def test_cycles_by_doubling(spark):
    """A long chain ends; circles of 1, 2, 3 and 1000 do not, nor does what hangs on them."""
    rows = [("chain", f"n{k}", f"n{k + 1}" if k < 99_999 else None) for k in range(100_000)]
    for n in (1, 2, 3, 1000):
        rows += [(f"round{n}", f"n{k}", f"n{(k + 1) % n}") for k in range(n)] + [(f"round{n}", "below", "n0"), (f"round{n}", "root", None), (f"round{n}", "leaf", "root"), (f"round{n}", "lost", "nowhere")]
    frame = spark.createDataFrame(rows + rows[:3], "bundle_id string, ref string, parent_ref string")
    got = sorted((r["bundle_id"], r["ref"]) for r in validation.cycles(frame).collect())
    assert got == sorted((f"round{n}", x) for n in (1, 2, 3, 1000) for x in [*(f"n{k}" for k in range(n)), "below"])
    assert validation.cycles(frame.limit(0)).count() == 0


def test_built_bundles_keep_the_contract(spark, tmp_path):
    stamp = "timestamp'2024-01-01 00:00:00'"
    documents = spark.sql(f"select 1L as doc_id, 'CJM 7' as code, cast(null as string) as edition, 'Tít\"ulo' as title, 'b' as branch, 'a.pdf' as source_path, 9 as page_count, 'docling' as extractor, {stamp} as ingested_at, {stamp} as generated_at, '{{\"a\": [1, \"ñ\"]}}' as metadata_json union all select 2L, 'M', null, 'Otro', null, 'b.pdf', 1, 'text', {stamp}, {stamp}, 'no json'")
    nodes = spark.sql("select * from values (11L, 1L, '01', cast(null as long), 0, 'PARTE', 'I', 'uno', 'b', 1, 2, false), (12L, 1L, '01.01', 11L, 1, 'Capítulo', '', 'dos\n', 'b', 2, cast(null as int), true) t(node_id, doc_id, sort_key, parent_id, level, level_label, ordinal, title, breadcrumb, page_start, page_end, is_anexo)")
    chunks = spark.sql("select * from values (12L, 1, 'b \"x\" \\\\', 5, 1, 1, true, false), (12L, 0, 'a', 1, 1, 1, false, false), (99L, 0, 'lost', 1, 1, 1, false, false) t(node_id, ordinal, text, char_count, page_start, page_end, has_table, has_image_ref)")
    runs = spark.sql(f"select 5L as run_id, 1L as doc_id, 'm' as model, 'batch' as mode, 'succeeded' as status, {stamp} as started_at, cast(null as timestamp) as completed_at, 2 as nodes_total, 1 as nodes_completed, 1 as nodes_failed, 0.12345678d as cost_estimate_usd, 'legal' as profile_used, '{{\"k\": 1}}' as rules_json")
    questions = spark.sql(f"select 7L as question_id, 5L as run_id, 11L as node_id, 1L as doc_id, 0 as generation_order, '¿?' as question_text, 'j' as justification, 'valid' as status, {stamp} as validated_at, {stamp} as created_at, '{{\"raw\": true}}' as raw_response_json")
    options = spark.sql("select 7L as question_id, k as order_in_question, element_at(array('correct', 'confusa', 'distractor', 'distractor'), k + 1) as role, concat('o', k) as text, k = 0 as is_correct from (select explode(array(3, 0, 2, 1)) as k)")
    built = contract.build(documents, nodes, chunks, runs, questions, options)
    assert contract_checks.errors(built).collect() == []
    one, two = (json.loads(r["json"]) for r in built.orderBy("bundle_id").collect())
    assert list(one) == ["bundle_version", "generated_at", "generator", "manual", "catalog_hint", "nodes", "runs", "questions"]
    assert one["manual"] == {"code": "CJM 7", "edition": None, "title": 'Tít"ulo', "branch": "b", "source_path": "a.pdf", "source_sha256": None, "page_count": 9, "extractor_used": "docling", "ingested_at": "2024-01-01T00:00:00Z", "metadata": {"a": [1, "ñ"]}}
    assert one["catalog_hint"] == {"grado_code": "SARG_2", "materia_code": "JUS_MIL"} and two["catalog_hint"]["materia_code"] == "OPS_MIL"
    assert [list(n) for n in one["nodes"]] == [list(NODE)] * 2 and [c["text"] for c in one["nodes"][1]["chunks"]] == ["a", 'b "x" \\']
    assert list(one["nodes"][1]["chunks"][0]) == list(CHUNK) and one["nodes"][1]["parent_ref"] == "01" and one["nodes"][0]["parent_ref"] is None
    assert [list(r) for r in one["runs"]] == [list(RUN)] and one["runs"][0]["cost_estimate_usd"] == 0.123457 and one["runs"][0]["rules_snapshot"] == {"k": 1}
    assert list(one["questions"][0]) == list(QUESTION) and [o["order_in_question"] for o in one["questions"][0]["options"]] == [0, 1, 2, 3]
    assert two["manual"]["metadata"] == {} and two["nodes"] == two["runs"] == two["questions"] == []
    path = f"file://{tmp_path}/out"
    told = export.export_store(documents, nodes, chunks, runs, questions, options, path)
    assert sorted((r["bundle_id"], r["rule"]) for r in told.collect()) == [("1", "failed_nodes"), ("1", "uncovered"), ("2", "no_questions")]
    assert [r["json"] and json.loads(r["json"])["manual"]["code"] for r in bundle_files.checked(spark, path).orderBy("name").collect()] == ["CJM 7", "M"]
    asked = spark.createDataFrame([(99,)], "run_id long")
    for change in (dict(requested=asked), dict(questions=questions.withColumn("justification", F.lit(" ")))):
        tables = dict(documents=documents, nodes=nodes, chunks=chunks, runs=runs, questions=questions, options=options) | change
        with pytest.raises(export.Unsound):
            export.export_store(**tables, path=path)
    assert bundle_files.read(spark, path).count() == 2
    raw = json.loads(contract.build(documents, nodes, chunks, runs, questions, options, include_raw=True).filter("bundle_id = '1'").first()["json"])
    assert raw["questions"][0]["raw_response"] == {"raw": True}


def rows_of(spark, *codes, day="2024-05-06"):
    return spark.createDataFrame([(c, json.dumps({"code": c, "ñ": [1, {}]})) for c in codes], "code string, json string").withColumn("generated_at", F.lit(day).cast("timestamp"))


def test_bundle_files(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    os.makedirs(tmp_path / "out")
    first = bundle_files.versioned(rows_of(spark, "Código 1", "b"), bundle_files.names(spark, path))
    bundle_files.write(first.repartition(3), path)
    assert sorted(os.listdir(tmp_path / "out")) == ["b--20240506--v1.json", "b--20240506--v1.json.sha256", "c-digo-1--20240506--v1.json", "c-digo-1--20240506--v1.json.sha256"]
    whole = (tmp_path / "out/b--20240506--v1.json").read_text()
    assert whole == '{\n  "code": "b",\n  "ñ": [\n    1,\n    {}\n  ]\n}\n'
    # numbered by code whatever the day; large ones compressed, the same bytes each time
    later = bundle_files.versioned(rows_of(spark, "b", day="2024-07-01"), bundle_files.names(spark, path))
    bundle_files.write(later, path, gzip_bytes=10)
    packed = (tmp_path / "out/b--20240701--v2.json.gz").read_bytes()
    assert gzip.decompress(packed).decode() == whole and packed == gzip.compress(whole.encode(), mtime=0)
    assert {r["next_version"] for r in bundle_files.next_versions(bundle_files.names(spark, path)).filter("slug = 'b'").collect()} == {3}
    got = {r["name"]: r for r in bundle_files.checked(spark, path).collect()}
    assert len(got) == 3 and got["b--20240701--v2.json.gz"]["version"] == 2 and json.loads(got["b--20240701--v2.json.gz"]["json"])["code"] == "b"
    # corrupt and without a digest
    (tmp_path / "out/b--20240506--v1.json").write_text("{}")
    os.remove(tmp_path / "out/c-digo-1--20240506--v1.json.sha256")
    (tmp_path / "out/notes.json").write_text("x")
    states = {r["name"]: r["state"] for r in bundle_files.read(spark, path).collect()}
    assert states == {"b--20240506--v1.json": "mismatch", "c-digo-1--20240506--v1.json": "missing", "b--20240701--v2.json.gz": "ok"}
    with pytest.raises(bundle_files.Corrupt, match="mismatch.*missing"):
        bundle_files.checked(spark, path)
    assert bundle_files.checked(spark, path, skip_checksum=True).count() == 3


def test_failed_writes_leave_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    broken = rows_of(spark, *"abcdef").withColumn("json", F.when(F.col("code") == "f", "{").otherwise(F.col("json")))
    with pytest.raises(Exception, match="JSON|Expecting"):
        bundle_files.write(bundle_files.versioned(broken, spark.createDataFrame([], "name string")).repartition(6), path)
    assert os.listdir(tmp_path / "out") == []
    good = bundle_files.versioned(rows_of(spark, "a", "b"), spark.createDataFrame([], "name string"))
    bundle_files.write(good, path)
    before = sorted(os.listdir(tmp_path / "out"))
    for again in (good, good.filter("slug = 'a'").withColumn("version", F.lit(5)).union(good.filter("slug = 'a'").withColumn("version", F.lit(5)))):
        with pytest.raises(Exception, match="exist already"):
            bundle_files.write(again, path)
        assert sorted(os.listdir(tmp_path / "out")) == before
    with pytest.raises(Exception, match="never replaced"):
        good.select("slug", "day", "version", "json").write.format("bundle").mode("overwrite").save(path)


def test_driver_holds_few_bytes_of_each_bundle(tmp_path):
    """Very many bundles: neither what tasks report nor the partitions to be read hold names at length."""
    n, path = 6001, f"file://{tmp_path}/out"
    os.makedirs(tmp_path / "out")
    rows = [{"slug": f"a-rather-long-code-{k % 7}", "day": "20240506", "version": k, "json": f'{{"k": {k}}}'} for k in range(n)]
    writer = bundle_files.BundleWriter({"path": path})
    told = [writer.write(iter(rows[::2])), writer.write(iter(rows[1::2])), None]
    assert len(pickle.dumps(told)) < 10 * n
    writer.commit(told)
    assert len(os.listdir(tmp_path / "out")) == 2 * n
    want = {f"{r['slug']}--20240506--v{r['version']}.json" for r in rows}
    for options in ({}, {"namesonly": "true"}):
        reader = bundle_files.BundleReader({"path": path} | options)
        parts = reader.partitions()
        assert len(parts) > 1 and len(pickle.dumps(parts)) < 10 * n
        got = [r for p in parts for r in reader.read(p)]
        assert len(got) == n and {r[0] for r in got} == want and all(options or r[-1] == "ok" for r in got)
    # one name in two tasks, compressed in one of them
    twice = bundle_files.BundleWriter({"path": path, "gzipbytes": "20"})
    told = [twice.write(iter([{"slug": "b", "day": "20240506", "version": 1, "json": x}])) for x in ('{"k": 1}', '{"k": "a longer one, to be compressed"}')]
    with pytest.raises(FileExistsError, match="twice.*b--20240506--v1"):
        twice.commit(told)
    assert len(os.listdir(tmp_path / "out")) == 2 * n


def test_secrets_are_traced_however_they_are_written(spark):
    """A text is looked through only where it shows a trace; escapes must hide none, and a bundle without one is left alone."""
    hidden = {"k": "A" + "Iza" + "x" * 20, "s": "sk" + "-" + "x" * 20, "c": "postgres://u:p@h", "p": "-----BEGIN " + "PRIVATE KEY-----"}
    rows = [(k, json.dumps(SOUND | {"extra": v})) for k, v in hidden.items()] + [("u" + k, json.dumps(SOUND | {"extra": "@"}).replace("@", "".join(f"\\u{ord(c):04x}" for c in v))) for k, v in hidden.items()]
    rows += [("slash", json.dumps(SOUND | {"extra": hidden["c"]}).replace("/", "\\/")), ("name", json.dumps(SOUND | {"Api-Key": "x" * 12})), ("uname", json.dumps(SOUND | {"@": "x" * 12}).replace("@", "\\u0061pi_key"))]
    rows += [("none", json.dumps(SOUND | {"extra": "a token, no sk- and http:/x"}))]
    got = {r["bundle_id"] for r in contract_checks.errors(spark.createDataFrame(rows, "bundle_id string, json string")).collect() if r["rule"] == "secret"}
    assert got == {r[0] for r in rows} - {"none"}


def test_each_object_is_taken_apart_once(spark):
    """Chunks' fields and kinds are taken together: as many looks into the variant as there are objects, not fields times rules."""
    rules = contract_checks._node_rules()
    assert rules.count("schema_of_variant") <= 20 and "try_variant_get(c, " not in rules
