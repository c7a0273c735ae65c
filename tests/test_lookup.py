"""Single documents, sections and questions out of a store."""

from pyspark.sql import functions as F

from folium.operators import lookup
from folium.sources.store import Store

NODES = "doc_id long, local_id long, pos int, parent_pos int, level int, level_label string, ordinal string, title string, breadcrumb string, page_start int, page_end int, sort_key string, is_anexo boolean"
CHUNKS = "doc_id long, local_id long, ordinal int, text string, char_count int, page_start int, page_end int, has_table boolean, has_image_ref boolean"


def filled(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store").create()
    docs = spark.createDataFrame([(k, f"D{k}") for k in (7, 8, -(1 << 60))], "doc_id long, title string")
    docs = docs.select("doc_id", "title", *(F.lit(None).cast(k).alias(n) for n, k in (("code", "string"), ("edition", "string"), ("branch", "string"), ("source_path", "string"), ("page_count", "int"), ("extractor", "string"), ("ingested_at", "timestamp"), ("metadata_json", "string"))))
    nodes = spark.createDataFrame([(d, k, k * 10, 0 if k else None, min(k, 1), "Capítulo" if k else "PARTE", "I", f"t{k}" if k != 2 else "", f"b{k}", k, 0, "01" if not k else f"01.{k:02}", k == 3) for d in (7, 8, -(1 << 60)) for k in (3, 1, 0, 2)], NODES)
    chunks = spark.createDataFrame([(d, k, o, "x" * 401, 401, 1, 1, False, False) for d in (7, -(1 << 60)) for k in (2, 1) for o in (1, 0)], CHUNKS)
    store.save_document(docs, nodes, chunks)
    return store


def test_points(spark, tmp_path):
    store = filled(spark, tmp_path)
    assert [r["title"] for r in store.document(8).collect()] == ["D8"] and store.document(9).count() == 0
    for d, counts in ((7, [0, 2, 2, 0]), (8, [0, 0, 0, 0]), (-(1 << 60), [0, 2, 2, 0]), (9, [])):
        rows = store.tree(d).collect()
        assert [r["n_chunks"] for r in rows] == counts and [r["local_id"] for r in rows] == list(range(len(counts)))
        for r in rows:
            assert store.section(r["node_id"]).collect() == [r]
    one = store.table("nodes").filter("doc_id = 7 and local_id = 1").first()["node_id"]
    assert [r["ordinal"] for r in lookup.section_chunks(store.table("chunks"), one).collect()] == [0, 1]
    assert {len(r["preview"]) for r in lookup.previews(store.table("chunks")).collect()} == {401} and {r["preview"] for r in lookup.previews(store.table("chunks"), 401).collect()} == {"x" * 401}
    plan = store.document(8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(doc_id,8)") == 2


def test_files_are_in_order(spark, tmp_path):
    store = filled(spark, tmp_path)
    for name, order in (("nodes", ["local_id"]), ("chunks", ["local_id", "ordinal"])):
        rows = spark.read.parquet(f"{store.path}/{name}").select("_metadata.file_path", "doc_id", *order).collect()
        for path in {r["file_path"] for r in rows}:
            there = [tuple(r)[1:] for r in rows if r["file_path"] == path]
            assert there == sorted(there)


def test_picking(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k long, x string")
    got = lambda wanted: sorted(r["x"] for r in lookup.pick(rows, "k", wanted).collect())
    assert got(2) == ["b", "d"] and got((1, 2)) == ["a", "b", "d"] and got([]) == []
    assert got(spark.createDataFrame([(2,), (2,), (None,)], "k long")) == ["b", "d"] and lookup.pick(rows, "x", "c").count() == 1


def test_a_question_with_all_it_needs(spark, tmp_path):
    store = filled(spark, tmp_path)
    node = store.table("nodes").filter("doc_id = 7 and local_id = 1").first()["node_id"]
    options = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(x).alias("text")) for r, x in (("distractor", "z"), ("correct", "y"))))
    rows = spark.createDataFrame([(5, 1, node, 7, 1, "q", "j"), (6, 1, 99, 7, 2, "r", "j")], "question_id long, run_id long, node_id long, doc_id long, generation_order int, question_text string, justification string")
    store.save_questions(rows.withColumns({"options": F.when(F.col("question_id") == 5, options).otherwise(F.filter(options, lambda o: o["role"] == "")), "created_at": F.current_timestamp()}))
    store.review(rows.filter("question_id = 5"), "valid", 1)
    five, six = store.question(5).first(), store.question(6).first()
    assert (five["breadcrumb"], five["pages"], five["status"], [tuple(o) for o in five["options"]]) == ("b1", "p. 1", "valid", [("distractor", "z"), ("correct", "y")])
    assert (six["breadcrumb"], six["pages"], six["status"], six["options"]) == (None, None, "pending", []) and store.question(7).count() == 0


def test_labels_and_neighbours(spark, tmp_path):
    tree = filled(spark, tmp_path).tree(7)
    assert [r[0] for r in tree.select(lookup.label()).collect()] == ["📚 t0", "📖 **Capítulo I** — t1   ·  2 chunk(s)", "📖 **Capítulo I**   ·  2 chunk(s)", "📎 **Capítulo I** — t3"]
    nodes = spark.createDataFrame([(1, 0, 0, None), (1, 1, 5, 0), (1, 2, 9, 0), (1, 3, 12, None), (2, 0, 0, None)], "doc_id long, local_id long, pos int, parent_pos int")
    got = {(r["doc_id"], r["local_id"]): tuple(r)[2:] for r in lookup.neighbours(nodes).collect()}
    assert got == {(1, 0): (1, 2, None, 3), (1, 3): (2, 2, 0, None), (1, 1): (1, 2, None, 2), (1, 2): (2, 2, 1, None), (2, 0): (1, 1, None, None)}
    assert lookup.neighbours(nodes.limit(0)).count() == 0
