import random
import re

from pyspark.sql import functions as F

from folium.functions import headings
from folium.operators import chunking, contents, hierarchy, quality
from folium.plans import ingest
from folium.sources import layout
from folium.sources.store import Store


def frame(spark, rows, doc=1):
    full = [(doc, i, p, p - 1, k, t) for i, (t, p, k) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, pos int, page_number int, physical_page_index int, kind string, text string")


MANUAL = [("PRIMERA PARTE", 1, "title"), ("LA GUERRA", 1, "narrative"), ("Capítulo I", 1, "title"), ("Teoría de la Guerra", 1, "narrative"), ("Primera Sección", 1, "title"), ("Generalidades", 1, "narrative"), ("Cuerpo del párrafo de generalidades.", 2, "narrative"), ("Capítulo II", 5, "title"), ("Principios de la Guerra", 5, "narrative")]


def test_manual(spark):
    rows = hierarchy.annotate(frame(spark, [("antes", 1, "narrative"), *MANUAL, ("pie", 6, "page_footer")]))
    nodes = hierarchy.nodes(rows).orderBy("local_id").collect()
    assert [(n["sort_key"], n["level_label"], n["title"], n["page_start"], n["page_end"]) for n in nodes] == [
        ("01", "PARTE", "LA GUERRA", 1, 1), ("01.01", "Capítulo", "Teoría de la Guerra", 1, 1), ("01.01.01", "Sección", "Generalidades", 1, 2), ("01.02", "Capítulo", "Principios de la Guerra", 5, 5),
    ]
    assert nodes[2]["breadcrumb"] == "PARTE PRIMERA — LA GUERRA › Capítulo I — Teoría de la Guerra › Sección Primera — Generalidades"
    assert [r["local_id"] for r in hierarchy.body(rows).orderBy("pos").collect()] == [None, 0, 1, 2, 2, 3]


def test_notes_and_articles(spark):
    rows = [("LIBRO PRIMERO", 1, "title"), ("CAPITULO I", 1, "title"), ("Artículo 1o.- Uno", 1, "narrative"), ("Artículo reformado DOF 13-06-2014", 1, "narrative")]
    legal = hierarchy.nodes(hierarchy.annotate(frame(spark, rows), headings.LEGAL_CODE), headings.LEGAL_CODE).orderBy("local_id").collect()
    assert [n["level_label"] for n in legal] == ["LIBRO", "Capítulo"] and legal[1]["annotations"] == [{"reforma_dof": "13-06-2014"}]
    opted = hierarchy.nodes(hierarchy.annotate(frame(spark, rows), headings.LEGAL_ARTICLES), headings.LEGAL_ARTICLES).orderBy("local_id").collect()
    assert [(n["level_label"], n["parent_pos"]) for n in opted] == [("LIBRO", None), ("Capítulo", 0), ("Artículo", 1)]


def stack(levels):
    """Parents, keys and crumbs the sequential way."""
    out, open_, counts = [], [], [0] * 6
    for pos, level in levels:
        while open_ and open_[-1][1] >= level:
            open_.pop()
        counts[level] += 1
        counts[level + 1 :] = [0] * (5 - level)
        out.append((open_[-1][0] if open_ else None, ".".join(f"{c:02d}" for c in counts[: level + 1])))
        open_.append((pos, level))
    return out


def test_places_against_a_stack(spark):
    rng = random.Random(4)
    docs = {d: [(p, rng.randint(0, 4)) for p in sorted(rng.sample(range(300), rng.randint(1, 130)))] for d in range(20)}
    docs[99] = [(p, 0) for p in range(120)]
    rows = spark.createDataFrame([(d, p, level) for d, x in docs.items() for p, level in x], "doc_id int, pos int, level int")
    got = {(r["doc_id"], r["pos"]): (r["parent_pos"], r["sort_key"]) for r in hierarchy.with_places(rows).collect()}
    for d, x in docs.items():
        assert [got[d, p] for p, _ in x] == stack(x)


def consolidate(nodes, elements, merge):
    """Bottom up, the sequential way: (local_id, parent_id, is_anexo), element lists by node."""
    body = {n: list(elements.get(n, ())) for n, _, _ in nodes}
    out = {}
    for n, parent, anexo in reversed(nodes):
        parts = [e.strip() for e in body[n] if e.strip()]
        text = "\n\n".join(sequential_fractions(parts))
        if anexo or not text:
            continue
        if len(text) < merge and parent is not None:
            body[parent] += body[n]
        else:
            out[n] = text
    return out


def test_merging_against_the_sequential_way(spark):
    rng = random.Random(8)
    node_rows, body_rows, want = [], [], {}
    for d in range(25):
        levels = [(p, rng.randint(0, 3)) for p in range(0, 10 * rng.randint(1, 15), 10)]
        places = stack(levels)
        nodes = [(i, None if up is None else up // 10, rng.random() < 0.1) for i, (up, _) in enumerate(places)]
        elements = {i: [rng.choice(["Artículo 1. x", "I.- a", "II.- b", "III.- c", "text " * rng.randint(0, 9), " "]) for _ in range(rng.randint(0, 5))] for i, _, _ in nodes}
        for (i, _, anexo), (pos, level), (up, _) in zip(nodes, levels, places):
            node_rows.append((d, i, pos, level, up, anexo, 1, 1))
            body_rows += [(d, i, pos + 1 + k, 1, "narrative", t) for k, t in enumerate(elements[i])]
        want |= {(d, n): t for n, t in consolidate(nodes, elements, 40).items()}
    n = spark.createDataFrame(node_rows, "doc_id long, local_id long, pos int, level int, parent_pos int, is_anexo boolean, page_start int, page_end int")
    b = spark.createDataFrame(body_rows, "doc_id long, local_id long, pos int, page_number int, kind string, text string")
    got = {(r["doc_id"], r["local_id"]): r["text"] for r in chunking.merged(n, b, 40).collect()}
    assert got == want


def sequential_fractions(parts):
    """Fractions behind a later article go back behind the nearest lower one, ten times at most."""
    romans = dict(zip(chunking.ROMANS, range(1, 21), strict=True))

    def value(p):
        found = re.match(r"\s*([IVXLC]+)\s*(?:Bis|Ter|Quáter)?\.?\s*[-.]", p, re.IGNORECASE)
        return romans.get(found[1].upper()) if found else None

    article = lambda p: re.match(r"\s*artículo\s+\d+", p, re.IGNORECASE)
    for _ in range(10):
        for i in range(1, len(parts)):
            lower = [j for j in range(i) if value(parts[i]) and value(parts[j]) and value(parts[j]) < value(parts[i])]
            if lower and any(article(p) for p in parts[lower[-1] : i]):
                parts = [*parts[: lower[-1] + 1], parts[i], *parts[lower[-1] + 1 : i], *parts[i + 1 :]]
                break
        else:
            break
    return parts


def test_fractions(spark):
    parts = ["Artículo 4. x", "I.- a", "III.- c", "IV.- d", "Artículo 5. y", "II.- b", "V.- e", "Artículo 6. z"]
    rng = random.Random(8)
    cases = [parts, ["II.- b", "Artículo 1"], ["x"], []]
    for _ in range(300):
        cases.append([rng.choice([*(f" {rng.choice(chunking.ROMANS[:8])}{rng.choice(['.-', ' Bis. -', 'x', '.'])} t" for _ in range(3)), "artículo 7 x", "iv.- low", "texto", "XXV.- none"]) for _ in range(rng.randint(0, 25))])
    cases.append([f"{chunking.ROMANS[k % 20]}.- {k}" if k % 7 else f"Artículo {k}" for k in range(600)])
    frame = spark.createDataFrame([(c,) for c in cases], "parts array<string>")
    got = [r[0] for r in frame.select(chunking.reordered(F.col("parts"))).collect()]
    assert [p.split(".")[0] for p in got[0]] == ["Artículo 4", "I", "II", "III", "IV", "V", "Artículo 5", "Artículo 6"] and got[1] == cases[1]
    assert got == [sequential_fractions(c) for c in cases]


def test_no_python_in_merging(spark):
    rows = hierarchy.annotate(frame(spark, MANUAL))
    plan = chunking.merged(hierarchy.nodes(rows), hierarchy.body(rows), 100)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def sequential_pack(text, s):
    if len(text) <= s.most:
        return [text]
    out, now = [], ""
    for p in [p for p in text.split("\n\n") if p.strip()]:
        if not now:
            now = p
        elif len(now) + len(p) + 2 <= s.soft:
            now += "\n\n" + p
        else:
            out.append(now)
            now = (now[-s.overlap :] + "\n\n" + p) if s.overlap else p
    return [*out, now] if now else out


def test_packing(spark):
    rng = random.Random(2)
    texts = ["Texto corto.", "\n\n".join(f"Párrafo {i}. " * 40 for i in range(10)), "x" * 5000, *("\n\n".join("ab " * rng.randint(0, 90) for _ in range(rng.randint(1, 30))) for _ in range(25))]
    for sizes in (chunking.Sizes(800, 600, 50), chunking.Sizes(300, 200, 0)):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.pack(F.col("t"), sizes).alias("p")).orderBy("i").collect()
        assert [r["p"] for r in rows] == [sequential_pack(t, sizes) for t in texts]


def test_tables_and_figures(spark):
    rows = frame(spark, [("Capítulo I", 1, "title"), ("| a | b |", 2, "table"), ("plano", 2, "figure"), ("Encabezado", 2, "heading"), ("fin", 3, "narrative")])
    nodes, chunks = ingest.sections(rows, headings.MANUAL, chunking.DEFAULT)
    c = chunks.collect()
    assert len(c) == 1 and c[0]["has_table"] and c[0]["has_image_ref"] and (c[0]["page_start"], c[0]["page_end"]) == (1, 3)
    assert c[0]["text"] == "[TABLA]\n| a | b |\n[/TABLA]\n\n[FIGURA: plano]\n\nfin"


def test_report(spark):
    docs = spark.createDataFrame([(1, 10), (2, 0)], "doc_id long, page_count int")
    nodes = spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, local_id long")
    chunks = spark.createDataFrame([(1, 0, 2, 4, 100), (1, 0, 4, 5, 50), (1, 0, 9, 3, 30)], "doc_id long, local_id long, page_start int, page_end int, char_count int")
    got = [tuple(r) for r in quality.report(docs, nodes, chunks).orderBy("doc_id").collect()]
    assert got == [(1, 2, 3, 1, 4, 40.0, 60.0), (2, 0, 0, 0, 0, 0.0, 0.0)]


def test_ingest_fills_the_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store").create()
    store.create()
    rows = frame(spark, MANUAL, 7).unionByName(frame(spark, [("LIBRO PRIMERO", 1, "title"), ("Código de x", 1, "narrative"), ("CAPITULO I", 1, "title"), ("Artículo 1o.- Uno", 1, "narrative")], 8))
    documents = spark.createDataFrame([(7, "A", 5), (8, "B", 1)], "doc_id long, code string, page_count int")
    for c, kind in (("title", "string"), ("edition", "string"), ("branch", "string"), ("source_path", "string"), ("extractor", "string"), ("ingested_at", "timestamp"), ("metadata_json", "string")):
        documents = documents.withColumn(c, F.lit(None).cast(kind))
    report = {r["doc_id"]: r["n_nodes"] for r in ingest.run(store, documents, rows).collect()}
    assert report == {7: 4, 8: 2}
    nodes = store.table("nodes")
    assert nodes.filter("parent_id is null").count() == 2
    assert nodes.alias("a").join(nodes.alias("b"), F.expr("a.parent_id = b.node_id")).filter("not startswith(a.sort_key, b.sort_key || '.')").count() == 0
    assert {r["doc_id"] for r in store.table("chunks").select("doc_id").collect()} == {7, 8}
    # saving again replaces, and rows that no save has logged are not there
    before = {c: store.table(c).count() for c in ("documents", "nodes", "chunks")}
    ingest.run(store, documents, rows).collect()
    assert {c: store.table(c).count() for c in before} == before
    store.append("documents", documents.withColumn("save_id", F.lit("half")))
    assert store.table("documents").count() == 2


LEGAL = [("LIBRO PRIMERO", 1, "title"), ("Código de x", 1, "narrative"), ("1 de 141", 1, "narrative"), ("CAPITULO I", 1, "title"), ("Artículo 1o.- Uno", 1, "narrative"), ("Artículo reformado DOF 13-06-2014", 2, "narrative")]


def test_profiles_in_one_pass(spark):
    """Documents of several genres at once are as each under its own profile."""
    told = {1: ("manual", MANUAL), 2: ("codigo_legal", LEGAL), 3: ("ley_organica", LEGAL), 4: ("manual", LEGAL)}
    all_ = None
    for k, (name, lines) in told.items():
        rows = frame(spark, lines, k).withColumn("profile", F.lit(name))
        all_ = rows if all_ is None else all_.unionByName(rows)
    marked = hierarchy.annotate(all_, None)
    nodes, body = hierarchy.nodes(marked, None), hierarchy.body(marked)
    for k, (name, _) in told.items():
        alone = hierarchy.annotate(all_.filter(F.col("doc_id") == k).drop("profile"), headings.profile(name))
        for mine, own in ((nodes, hierarchy.nodes(alone, headings.profile(name))), (body, hierarchy.body(alone))):
            assert sorted(map(repr, mine.filter(F.col("doc_id") == k).select(*own.columns).collect())) == sorted(map(repr, own.collect()))


CONTENTS = ["ÍNDICE", "PRIMERA PARTE ......... 3", "Capítulo I - De la guerra ........ 3", "Capítulo II - De la paz ......... 4", "Primera Sección .......... 4", "Capítulo III ........ 6", "Anexos varios ........ 9"]


def with_contents(spark, doc_id):
    lines = [(t, 1, "narrative") for t in CONTENTS]
    lines += [("prólogo de hoy", 5, "narrative"), ("sigue", 6, "narrative"), ("PRIMERA PARTE", 5, "heading"), ("Capítulo I - De la guerra", 5, "heading"), ("texto uno", 5, "narrative"), ("Capítulo II - De la paz", 6, "heading"), ("pie", 6, "page_footer"), ("Segunda Sección", 6, "heading"), ("texto dos", 6, "narrative"), ("Capítulo III", 8, "heading"), ("texto tres", 9, "narrative")]
    return frame(spark, lines, doc_id)


def test_contents_path(spark, tmp_path):
    rows = with_contents(spark, 5).unionByName(frame(spark, MANUAL, 7)).withColumn("profile", F.lit("manual"))
    found = contents.found_in(rows)
    assert {r["doc_id"] for r in found.select("doc_id").collect()} == {5}
    marked = contents.annotate(found, rows.filter("doc_id = 5"), None)
    nodes = hierarchy.nodes(marked, None).orderBy("local_id").collect()
    assert [(n["level"], n["level_label"], n["ordinal"], n["title"], n["page_start"], n["sort_key"]) for n in nodes] == [
        (0, "PARTE", "PRIMERA", "PRIMERA PARTE", 3, "01"), (1, "Capítulo", "I", "De la guerra", 3, "01.01"), (1, "Capítulo", "II", "De la paz", 4, "01.02"),
        (2, "Sección", "Primera", "Primera Sección", 4, "01.02.01"), (1, "Capítulo", "III", "Capítulo III", 6, "01.03"), (0, "PARTE", "", "Anexos varios", 9, "02"),
    ]
    body = {r["text"]: r["local_id"] for r in hierarchy.body(marked).collect()}
    assert body["texto uno"] == 1 and body["texto dos"] == 2 and body["Segunda Sección"] == 2 and body["texto tres"] == 4 and "Capítulo I - De la guerra" not in body and "pie" not in body
    # before a heading of the contents has come: by the printed page, two behind the counted one
    assert body["prólogo de hoy"] == 1 and body["sigue"] == 3 and body["ÍNDICE"] is None
    store = Store(spark, f"file://{tmp_path}/store").create()
    documents = spark.createDataFrame([(5, "A", 9), (7, "B", 5)], "doc_id long, code string, page_count int")
    for c, kind in (("title", "string"), ("edition", "string"), ("branch", "string"), ("source_path", "string"), ("extractor", "string"), ("ingested_at", "timestamp"), ("metadata_json", "string")):
        documents = documents.withColumn(c, F.lit(None).cast(kind))
    report = {r["doc_id"]: r["n_nodes"] for r in ingest.run(store, documents, rows.drop("profile"), prefer_contents=True).collect()}
    assert report == {5: 6, 7: 4}


def test_text_files_are_ingested(spark, tmp_path):
    """Documents are numbered by a hash of their files' names, of any size."""
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / f"in/{k}.txt").write_text("PRIMERA PARTE\nCapítulo I\nTítulo\nTexto del capítulo\nCapítulo II\nMás texto\n")
    rows = layout.reader("text")(spark, f"file://{tmp_path}/in")
    documents = rows.groupBy("doc_id").agg(F.max("page_number").alias("page_count"))
    for c, kind in (("code", "string"), ("title", "string"), ("edition", "string"), ("branch", "string"), ("source_path", "string"), ("extractor", "string"), ("ingested_at", "timestamp"), ("metadata_json", "string")):
        documents = documents.withColumn(c, F.lit(None).cast(kind))
    assert documents.filter(F.abs("doc_id") > 1 << 43).count() > 0
    store = Store(spark, f"file://{tmp_path}/store").create()
    assert [r["n_nodes"] for r in ingest.run(store, documents, rows).collect()] == [3] * 6
    nodes = store.table("nodes")
    assert nodes.select("node_id").distinct().count() == 18
    up = nodes.alias("a").join(nodes.alias("b"), F.expr("a.parent_id = b.node_id"))
    assert up.count() == 12 and up.filter("a.doc_id <> b.doc_id or not startswith(a.sort_key, b.sort_key || '.')").count() == 0
    assert store.table("chunks").join(nodes, ["doc_id", "local_id", "node_id"], "left_anti").count() == 0


def test_questions_and_reviews(spark, tmp_path):
    import pytest

    store = Store(spark, f"file://{tmp_path}/q").create()
    q = spark.createDataFrame([(1, 5, 9, 7, 0, "¿?", "j", None, [("correct", "a"), ("confusa", "b"), ("distractor", "c"), ("distractor", "d")])], "question_id long, run_id long, node_id long, doc_id long, generation_order int, question_text string, justification string, created_at timestamp, options array<struct<role:string, text:string>>")
    store.save_questions(q)
    assert [(r["order_in_question"], r["is_correct"]) for r in store.table("options").orderBy("order_in_question").collect()] == [(0, True), (1, False), (2, False), (3, False)]
    assert store.questions().first()["status"] == "pending"
    store.review(q, "needs_review", 1)
    store.review(q, "valid", 2)
    assert store.questions().first()["status"] == "valid"
    with pytest.raises(ValueError):
        store.review(q, "other", 3)
    assert store.exists("nodes") and not store.exists("nothing")
