import pytest
from pyspark.sql import functions as F

from folium.functions import cost, text
from folium.operators import contents, explore, generation, rules, search
from folium.sources import bundles, layout


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


def test_text(spark):
    lit = F.lit
    assert one(spark, text.strip(lit("  a b\t")), text.collapse(lit(" a \n b ")), text.capitalize(lit("ÚNICA x")), text.slug(lit("  DN M/1455 Ñ. ")), text.slug(lit("--"))) == ("a b", "a b", "Única x", "dn-m-1455", "manual")
    assert one(spark, *(text.roman_to_int(lit(x)) for x in ("xiv", "MCMXCIX", "iiq", ""))) == (14, 1999, 2, 0)
    assert one(spark, text.is_roman_only(lit("x i")), text.is_roman_only(lit("mil")), text.is_roman_only(lit("mila")), text.is_roman_only(lit(""))) == (True, True, False, False)
    assert one(spark, text.page_number(lit(" 17 ")), text.page_number(lit("xii"))) == (17, 12)
    assert one(spark, text.option_key(lit(" Uno\n  DOS ")), text.draft_option_key(lit(" Uno  DOS "))) == ("uno dos", "uno  dos")
    assert one(spark, text.without_options(lit("¿Qué? a) uno B) dos")), text.without_options(lit("¿Qué?"))) == ("¿Qué?", "¿Qué?")
    assert one(spark, text.page_label(lit(3), lit(None).cast("int")), text.page_label(lit(3), lit(5))) == ("p. 3", "pp. 3-5")
    assert one(spark, text.guess_code(lit("/a/Manual dn m 1455 x.pdf")), text.guess_code(lit("/a/ley-x.pdf")), text.guess_title(lit("/a/ley_de-x.pdf"))) == ("DN M 1455", "ley-x", "ley de x")
    assert one(spark, text.safe_int(lit("x")), text.safe_int(lit("7")), text.preview(lit("abc"), 2)) == (0, 7, "ab…")
    stamp = lit("2024-05-06 07:08:09.9").cast("timestamp")
    assert one(spark, text.iso(stamp), text.run_ref(lit("m"), lit("batch"), stamp), text.bundle_name(lit("A B"), stamp, lit(2))) == ("2024-05-06T07:08:09Z", "m--batch--20240506T070809Z", "a-b--20240506--v2.json")


def test_cost(spark):
    runs = spark.createDataFrame([("gemini-2.5-flash", "immediate", 10, 100000), ("gemini-2.5-flash", "batch", 10, 100000)], "model string, mode string, n_questions long, doc_tokens long")
    got = [tuple(r)[4:] for r in cost.planned(runs).collect()]
    assert got == [(0.03, 0.1, 0.00483, 0.1783), (0.03, 0.1, 0.003915, 0.1692)]
    with pytest.raises(Exception, match="no price"):
        cost.planned(runs.withColumn("model", F.lit("x"))).collect()
    used = spark.createDataFrame([("gemini-2.5-pro", "batch", 1000, 500, 2000, 0.0), ("x", "batch", 1, 1, 1, 0.0)], "model string, mode string, input_tokens long, output_tokens long, cached_tokens long, token_hours double")
    assert [r["cost_usd"] for r in cost.actual(used).collect()] == [0.00275, 0.0]
    assert one(spark, cost.resolve_model(F.lit(" Flash ")), cost.token_estimate(F.lit(10))) == ("gemini-2.5-flash", 2)


def test_search(spark):
    docs = spark.createDataFrame([(1, "La Guerra y la táctica"), (2, "guerra total, TACTICA naval"), (3, "la paz"), (4, "táctica de guerra de guerra")], "chunk_id long, text string")
    indexed = search.index(docs)
    find = lambda q: sorted(r["chunk_id"] for r in search.hits(indexed, search.parse(q)).collect())
    assert find("guerra tactica") == [1, 2, 4] and find('"guerra total"') == [2] and find("paz OR naval") == [2, 3] and find("la AND paz") == [3]
    assert find("NEAR(guerra táctica, 1)") == [2, 4] and search.parse("  ") is None and search.parse("¡!") is None
    ranked = search.bm25(indexed, search.parse("guerra")).collect()
    assert [r["chunk_id"] for r in ranked] == [4, 1, 2] or [r["chunk_id"] for r in ranked][0] == 4
    changed = spark.createDataFrame([(3, "guerra")], "chunk_id long, text string")
    again = search.updated(indexed, changed, docs.filter("chunk_id = 1").select("chunk_id"))
    assert sorted(r["chunk_id"] for r in search.hits(again, search.parse("guerra")).collect()) == [2, 3, 4]
    assert docs.filter("chunk_id = 2").select(search.excerpt(F.col("text"), search.parse("tactica"), 2)).first()[0] == "…total, <mark>TACTICA</mark>…"


def test_contents(spark):
    lines = ["ÍNDICE", "PRIMERA PARTE", "LA GUERRA", "Capítulo I", "Teoría ............ 3", "    Doctrina ..... iv", "17", "Segunda parte", "Anexo B ...... 40"]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "doc_id long, pos int, text string")
    found = contents.entries(rows)
    got = [(r["title"], r["page"], r["depth"]) for r in found.orderBy("line_number", "n").collect()]
    assert got == [("PRIMERA PARTE — LA GUERRA", 3, 0), ("Capítulo I — Teoría", 3, 1), ("Capítulo I — Doctrina", 4, 1), ("SEGUNDA PARTE", 40, 0), ("Anexo B", 40, 0)] or got[0][0].startswith("PRIMERA PARTE")
    summary = contents.summary(rows, found).first()
    assert summary["n_entries"] == 5 and summary["found"] == (summary["confidence"] >= 0.4)
    assert [r["sort_key"] for r in contents.as_nodes(found).orderBy("pos").collect()][0] == "01"


def test_generation(spark):
    prompts = spark.createDataFrame([(1, "texto"), (2, " "), (3, "mal")], "key long, prompt string")

    def client(prompt):
        if prompt == "mal":
            raise RuntimeError("no")
        return generation.stub_client(prompt)

    got = {r["key"]: (r["response"], r["error"]) for r in generation.generate(prompts, client).collect()}
    assert got == {1: ("¿texto?", None), 2: (None, "empty prompt"), 3: (None, "RuntimeError: no")}
    drafts = spark.createDataFrame([(1, "q", "j", [("correct", "a"), ("confusa", " A "), ("distractor", "b"), ("distractor", "c")]), (2, "", "j", [("correct", "a")])], "question_id long, question_text string, justification string, options array<struct<role:string, text:string>>")
    assert sorted(map(tuple, generation.shape_errors(drafts).collect())) == [(1, "repeated_options"), (2, "four_options"), (2, "question_length"), (2, "roles")]
    q = spark.createDataFrame([(1, 1, "uno  dos"), (2, 1, "tres"), (3, 2, None)], "question_id long, node_id long, correct string")
    texts = spark.createDataFrame([(1, "cero uno\ndos")], "node_id long, text string")
    assert sorted(map(tuple, generation.citation_status(q, texts).collect())) == [(1, "pending"), (2, "needs_review"), (3, "pending")]
    numbered = generation.numbered(spark.createDataFrame([(1, "02", 0), (1, "01", 1), (1, "01", 0)], "run_id int, sort_key string, draft int"))
    assert sorted((r["sort_key"], r["draft"], r["generation_order"]) for r in numbered.collect()) == [("01", 0, 1), ("01", 1, 2), ("02", 0, 3)]


def test_overloads_wait_and_drafts(spark):
    prompts = spark.createDataFrame([(1, "x")], "key long, prompt string")

    def busy(prompt):
        raise RuntimeError("503 overloaded")

    row = generation.generate(prompts, busy, retries=3, wait=lambda attempt: 0.1 * (attempt + 1)).first()
    assert row["error"] == "RuntimeError: 503 overloaded" and 0.29 < row["seconds"] < 5
    assert 16 <= generation._wait(0) <= 20 and 121 <= generation._wait(3) <= 125
    one = '{"question_text": "q", "justification": "j", "options": [{"role": "correct", "text": "a"}]}'
    responses = spark.createDataFrame([(1, f"[{one}, {one}]", None), (2, "[]", None), (3, "no", None), (4, None, "gone"), (5, f"[{', '.join([one] * 6)}]", None)], "key long, response string, error string")
    got = sorted((r["key"], r["draft"], r["question_text"], r["error"]) for r in generation.drafts(responses).collect())
    assert got == [(1, 0, "q", None), (1, 1, "q", None), (2, None, None, "a response has one to five drafts"), (3, None, None, "not a list of drafts"), (4, None, None, "gone"), (5, None, None, "a response has one to five drafts")]


def test_cost_totals(spark):
    runs = spark.createDataFrame([(1, 7, "gemini-2.5-flash", "batch", 1000), (2, 8, "gemini-2.5-flash", "batch", 1000)], "run_id long, doc_id long, model string, mode string, doc_tokens long")
    nodes = spark.createDataFrame([(7, 70), (7, 71), (7, 71)], "doc_id long, node_id long")
    assert [(r["run_id"], r["n_questions"]) for r in cost.selected(nodes, runs).collect()] == [(1, 2)]
    bundles = spark.createDataFrame([("a", [(0.5,), (None,), (0.25,)]), ("b", [])], "bundle_id string, runs array<struct<cost_usd:double>>")
    assert {(r["bundle_id"], r["cost_usd"]) for r in cost.bundle_total(bundles).collect()} == {("a", 0.75), ("b", 0.0)}
    rows = cost.scenarios(spark.createDataFrame([(1, 2, 4000), (2, 1, 400)], "doc_id long, n_chunks long, chars long"))
    total = cost.scenario_totals(rows).first()
    assert (total["documents"], total["n_chunks"], total["tokens"]) == (2, 3, 1100) and abs(total["batch_usd"] - sum(r["batch_usd"] for r in rows.collect())) < 1e-9


def test_rules(spark):
    over = spark.createDataFrame([(1, '{"profile": "codigo_legal", "question_rules": {"forbidden_topics": [], "style_guide": "x"}}'), (2, "no json"), (3, None)], "doc_id long, metadata_json string")
    got = {r["doc_id"]: r for r in rules.merged(rules.table(spark), rules.from_metadata(over)).collect()}
    assert (got[1]["name"], got[1]["forbidden_topics"], got[1]["style_guide"]) == ("codigo_legal", [], "x")
    assert got[1]["preferred_topics"] == list(rules.default_rules("codigo_legal").preferred_topics) and got[2]["name"] == got[3]["name"] == "manual"
    with pytest.raises(ValueError):
        rules.default_rules("x")


def test_layout(spark, tmp_path):
    page = spark.createDataFrame([(1, "<h1>A <b>B</b></h1><script>var p='<p>x</p>'</script><p class=x>uno\n dos</p><ul><li>tres</li></ul><!-- <p>no</p> -->")], "page_id long, html string")
    assert [(r["kind"], r["text"]) for r in layout.from_html(page).orderBy("pos").collect()] == [("title", "A B"), ("narrative", "uno dos"), ("list_item", "tres")]
    (tmp_path / "cache" / "extractor=docling").mkdir(parents=True)
    (tmp_path / "cache" / "extractor=docling" / "a.json").write_text('{"doc_id": 1, "page_count": 2, "elements": [{"page_number": 1, "kind": "title", "text": "T"}]}\n{broken\n')
    assert [(r["doc_id"], r["text"]) for r in layout.reader("cache")(spark, f"file://{tmp_path}/cache").collect()] == [(1, "T")]
    box = one(spark, layout.bbox_of(F.expr("array(named_struct('x', 1d, 'y', 5d), named_struct('x', 3d, 'y', 2d))")))
    assert tuple(box[0]) == (1.0, 2.0, 3.0, 5.0)
    with pytest.raises(ValueError):
        layout.reader("x")


def test_display_tree_hides_descendants(spark):
    rows = spark.createDataFrame([(1, 0, 0, None, "01", "Introducción"), (1, 1, 1, 0, "01.01", "Uno"), (1, 2, 2, None, "02", "Dos"), (1, 3, 3, 2, "02.01", "")], "doc_id long, local_id long, pos int, parent_pos int, sort_key string, title string")
    assert [r["title"] for r in explore.display_tree(rows).collect()] == ["Dos"]
    assert [(r["local_id"], r["ancestor"]) for r in explore.ancestors(rows).orderBy("local_id").collect()] == [(1, 0), (3, 2)]


def test_next_versions(spark):
    files = spark.createDataFrame([("a-b--20240101--v3.json",), ("a-b--20230101--v12.json.gz",), ("c--20240101--v1.json",), ("c--x.json",)], "name string")
    assert sorted(map(tuple, bundles.next_versions(files).collect())) == [("a-b", 13), ("c", 2)]
