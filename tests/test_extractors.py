"""The layout source: both vendors' JSON, ranges of files, and the same elements as the column version gives."""

import json

import pytest
from pyspark.sql import functions as F

from folium.sources import extractors, layout

DOCLING = {
    "doc_id": 7,
    "body": {"children": [{"$ref": "#/texts/1"}, {"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}, {"$ref": "#/texts/9"}]},
    "groups": [{"children": [{"$ref": "#/texts/0"}, {"$ref": "#/texts/2"}]}],
    "texts": [
        {"self_ref": "#/texts/0", "label": "list_item", "text": " uno ", "marker": "-", "prov": [{"page_no": 2, "bbox": {"l": 1, "t": 2, "r": 3, "b": 4}}]},
        {"self_ref": "#/texts/1", "label": "section_header", "text": "Título", "level": 2, "prov": [{"page_no": 1}]},
        {"self_ref": "#/texts/2", "label": "text", "text": "  "},
    ],
    "tables": [{"self_ref": "#/tables/0", "label": "table", "prov": []}],
}
UNSTRUCTURED = [
    {"type": "Title", "text": "Título", "metadata": {"page_number": 1, "coordinates": {"points": [[1, 5], [4, 2]]}}},
    {"type": "NarrativeText", "text": " "},
    {"type": "FigureCaption", "text": "pie", "metadata": {}},
    {"type": "PageBreak", "text": "x"},
    {"type": "Image", "text": None},
]


def read(spark, path, extractor, **options):
    extractors.register(spark)
    return spark.read.format("layout").options(extractor=extractor, **options).load(f"file://{path}")


def test_docling(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCLING))
    rows = read(spark, tmp_path, "docling").orderBy("pos").collect()
    assert [(r["doc_id"], r["pos"], r["page_number"], r["physical_page_index"], r["kind"], r["text"], r["level"]) for r in rows] == [(7, 0, 1, 0, "heading", "Título", 2), (7, 1, 2, 1, "list_item", "- uno", None), (7, 2, 0, 0, "table", "", None)]
    assert rows[1]["bbox"].asDict() == {"x0": 1, "y0": 2, "x1": 3, "y1": 4} and rows[0]["bbox"] is None and rows[0]["metadata"] == {"docling_label": "section_header", "self_ref": "#/texts/1"}


def test_unstructured(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b.json").write_text(json.dumps(UNSTRUCTURED))
    (tmp_path / "broken.json").write_text("{")
    (tmp_path / "other.txt").write_text("x")
    rows = read(spark, tmp_path, "unstructured").orderBy("pos").collect()
    assert [(r["pos"], r["page_number"], r["kind"], r["text"]) for r in rows] == [(0, 1, "title", "Título"), (1, 0, "narrative", "pie"), (2, 0, "other", "x"), (3, 0, "figure", "")]
    assert {r["doc_id"] for r in rows} == {extractors.doc_id_of("b.json")} and rows[0]["bbox"].asDict() == {"x0": 1, "y0": 2, "x1": 4, "y1": 5}
    assert rows[0]["metadata"] == {"unstructured_category": "Title"}


@pytest.mark.parametrize("size", [150, 1000, 1 << 20])
def test_every_document_is_in_one_range(spark, tmp_path, size):
    docs = [{"doc_id": k, "elements": [{"type": "Title", "text": "ñ" * (k % 40)}] * 2} for k in range(60)]
    text = "\n".join(json.dumps(d, ensure_ascii=False) for d in docs[:40]) + "\n\n"
    (tmp_path / "a.jsonl").write_text(text)
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps(d) for d in docs[40:]))
    (tmp_path / "empty.jsonl").write_text("")
    rows = read(spark, tmp_path, "unstructured", rangeBytes=size)
    assert sorted((r["doc_id"], r["pos"]) for r in rows.select("doc_id", "pos").collect()) == [(k, p) for k in range(60) for p in (0, 1) if k % 40]
    if size == 150:
        assert rows.rdd.getNumPartitions() > 20


def test_same_as_columns(spark, tmp_path):
    """Against layout.normalise and layout.explode on the same items."""
    labels = [*layout.LABELS["docling"], "chart"]
    items = [{"label": x, "text": f" {x} " if k % 3 else " ", "marker": "*" if k % 4 == 0 else None, "prov": [{"page_no": k % 5, "bbox": {"l": k, "t": 0, "r": 1, "b": 1}}] if k % 2 else []} for k, x in enumerate(labels)]
    doc = {"doc_id": 3, "texts": items, "body": {"children": [{"$ref": f"#/texts/{k}"} for k in range(len(items))]}}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    place = "array<struct<page_no:int, bbox:struct<x0:double, y0:double, x1:double, y1:double>>>"
    rows = [(3, k, x["label"], x["text"], x["marker"], [(p["page_no"], (float(k), 0.0, 1.0, 1.0)) for p in x["prov"]]) for k, x in enumerate(items)]
    want = layout.normalise(spark.createDataFrame(rows, f"doc_id long, pos int, label string, text string, marker string, prov {place}"), "docling")
    got = read(spark, tmp_path, "docling")
    columns = ["page_number", "kind", "text", "bbox"]
    assert [tuple(r) for r in got.orderBy("pos").select(*columns).collect()] == [tuple(r) for r in want.orderBy("pos").select(*columns).collect()]
    result = spark.createDataFrame([(3, "docling", 1, [r.asDict() for r in got.orderBy("pos").select("page_number", "physical_page_index", "kind", "text", "level", "bbox", "metadata").collect()])], layout.RESULT)
    layout.write_cache(result, f"file://{tmp_path}/cache")
    cached = layout.explode(layout.read_cache(spark, f"file://{tmp_path}/cache"))
    assert sorted(map(repr, cached.select(*got.columns).collect())) == sorted(map(repr, got.collect()))


def test_columns_and_filters_above(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCLING))
    assert read(spark, tmp_path, "docling").filter(F.col("kind") == "table").select("text").collect()[0]["text"] == ""
    with pytest.raises(Exception, match="unknown extractor"):
        read(spark, tmp_path, "x").count()
    with pytest.raises(Exception, match="nowhere"):
        read(spark, tmp_path / "nowhere", "docling").count()
    assert layout.reader("docling")(spark, f"file://{tmp_path}").count() == 3


def test_cached_results_by_stem_then_code(spark, tmp_path):
    element = {"page_number": 1, "physical_page_index": 0, "kind": "title", "text": "t"}
    for name in ("guia.docling", "guia.unstructured", "CJM-1944.docling", "otra.docling"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"extractor": name.split(".")[1], "page_count": 1, "elements": [element | {"text": name}]}))
    (tmp_path / "rota.docling.json").write_text("{")
    wanted = spark.createDataFrame([(1, "/x/guia.pdf", "otra"), (2, "/x/lost.pdf", "cjm 1944"), (3, "/x/rota.pdf", "none"), (4, None, None)], "doc_id long, source_path string, code string")
    got = [(r["doc_id"], r["found_by"], r["elements"] and r["elements"][0]["text"]) for r in layout.cached(spark, f"file://{tmp_path}", wanted).orderBy("doc_id").collect()]
    assert got == [(1, "stem", "guia.docling"), (2, "code", "CJM-1944.docling"), (3, None, None), (4, None, None)]
