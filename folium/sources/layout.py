"""Layout elements from extractors' output: JSON caches, vendor labels, HTML pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions.text import strip
from folium.operators.elements import from_lines

ELEMENT = "struct<page_number:int, physical_page_index:int, kind:string, text:string, level:int, bbox:struct<x0:double, y0:double, x1:double, y1:double>, metadata:map<string,string>>"
RESULT = f"doc_id bigint, extractor string, page_count int, elements array<{ELEMENT}>"

# What extractors' labels stand for; all others, page breaks among them, are 'other'.
LABELS = {
    "docling": {
        "title": "title", "section_header": "heading", "section-header": "heading", "text": "narrative", "paragraph": "narrative", "list_item": "list_item", "list-item": "list_item",
        "table": "table", "figure": "figure", "picture": "figure", "page_header": "page_header", "page-header": "page_header", "page_footer": "page_footer", "page-footer": "page_footer",
        "footnote": "page_footer", "page_number": "page_number", "page-number": "page_number",
    },
    "unstructured": {
        "Title": "title", "Header": "page_header", "NarrativeText": "narrative", "ListItem": "list_item", "Table": "table", "Image": "figure", "Figure": "figure", "Footer": "page_footer",
        "FigureCaption": "narrative",
    },
    "html": {"h1": "title", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "p": "narrative", "li": "list_item", "table": "table", "figure": "figure", "header": "page_header", "footer": "page_footer"},
}


def kind_of(label: Column, extractor: str) -> Column:
    known = F.create_map(*(F.lit(x) for pair in LABELS[extractor].items() for x in pair))
    return F.coalesce(F.try_element_at(known, label), F.lit("other"))


def bbox_of(points: Column) -> Column:
    """The box around a polygon (array of struct x, y); null for none."""
    side = lambda f, axis: f(F.transform(points, lambda p: p[axis]))
    return F.when(F.size(points) > 0, F.struct(side(F.array_min, "x").alias("x0"), side(F.array_min, "y").alias("y0"), side(F.array_max, "x").alias("x1"), side(F.array_max, "y").alias("y1")))


def normalise(items: DataFrame, extractor: str) -> DataFrame:
    """Items (doc_id, pos, label, text, marker, prov: array of struct page_no and bbox) as elements.

    Text is stripped, with its list marker in front unless it is there; items without text go, but for tables and
    figures. Page and box are the first of their places, 0 and null without any.
    """
    bare = strip(F.coalesce("text", F.lit("")))
    marker = strip(F.coalesce("marker", F.lit("")))
    text = F.when((marker != "") & ~bare.startswith(marker), strip(F.concat(marker, F.lit(" "), bare))).otherwise(bare)
    place = F.try_element_at("prov", F.lit(1))
    page = F.coalesce(place["page_no"], F.lit(0))
    rows = items.select("doc_id", "pos", page.alias("page_number"), (page - 1).alias("physical_page_index"), kind_of(F.col("label"), extractor).alias("kind"), text.alias("text"), place["bbox"].alias("bbox"))
    return rows.filter((F.col("text") != "") | F.col("kind").isin("table", "figure"))


def from_html(pages: DataFrame) -> DataFrame:
    """(page_id, pos, kind, text) of headings, paragraphs, list items and tables in HTML, in order."""
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    found = F.regexp_extract_all(body, F.lit(r"(?is)(<(h[1-6]|p|li|table)\b[^>]*>.*?</\2>)"), 1)
    rows = pages.select("page_id", F.posexplode(found).alias("pos", "raw"))
    label = F.lower(F.regexp_extract("raw", r"^<(\w+)", 1))
    text = strip(F.regexp_replace(F.regexp_replace("raw", r"(?s)<[^>]*>", " "), r"\s+", " "))
    return rows.select("page_id", "pos", kind_of(label, "html").alias("kind"), text.alias("text"))


def write_cache(results: DataFrame, path: str) -> None:
    """Extraction results by RESULT, as JSON by extractor."""
    results.write.mode("overwrite").partitionBy("extractor").json(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cached results; what can't be parsed counts as not cached."""
    rows = spark.read.schema(f"{RESULT}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.filter("_corrupt is null").drop("_corrupt")


def explode(results: DataFrame) -> DataFrame:
    """(doc_id, pos, …) elements of results."""
    return results.select("doc_id", F.posexplode("elements").alias("pos", "e")).select("doc_id", "pos", "e.*")


def from_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files as elements, one a line."""
    files = spark.read.text(path, wholetext=True).select(F.xxhash64(F.col("_metadata.file_path")).alias("doc_id"), F.col("value").alias("text"))
    return from_lines(files)


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"cache": lambda spark, path: explode(read_cache(spark, path)), "text": from_text}


def reader(name: str) -> Callable[[SparkSession, str], DataFrame]:
    from folium.sources import extractors

    known = READERS | extractors.READERS
    if name not in known:
        raise ValueError(f"unknown extractor {name!r}; known: {sorted(known)}")
    return known[name]


def cached(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Of wanted (doc_id, source_path, code) the cached results: those named by the source's stem, else by the code.

    Cache files are {name}.{extractor}.json, one result each, the first extractor in order if there are several; what
    can't be parsed counts as not cached. In codes any run of other characters than letters and digits is alike.
    Returns (doc_id, found_by, elements); found_by is stem, code or null.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?\.json$", 1)
    files = files.select(name.alias("name"), F.from_json("value", RESULT.replace("doc_id bigint, ", "")).alias("r")).filter("r.elements is not null")
    files = files.groupBy("name").agg(F.min_by("r.elements", "r.extractor").alias("elements"))
    loose = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-")
    names = files.select(F.explode(F.array(F.struct(F.lit("stem").alias("found_by"), F.col("name").alias("name")), F.struct(F.lit("code").alias("found_by"), loose(F.col("name")).alias("name")))).alias("n"), "elements").select("n.*", "elements")
    names = names.groupBy("found_by", "name").agg(F.min_by("elements", F.to_json("elements")).alias("elements"))
    stem = F.regexp_replace(F.regexp_extract("source_path", r"([^/]*)$", 1), r"\.[^.]*$", "")
    asked = wanted.select("doc_id", F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.lit("stem").alias("found_by"), stem.alias("name")), F.struct(F.lit(1).alias("rank"), F.lit("code").alias("found_by"), loose(F.col("code")).alias("name")))).alias("a")).select("doc_id", "a.*")
    best = asked.join(names, ["found_by", "name"]).groupBy("doc_id").agg(F.min_by(F.struct("found_by", "elements"), "rank").alias("b"))
    return wanted.select("doc_id").join(best, "doc_id", "left").select("doc_id", "b.found_by", "b.elements")
