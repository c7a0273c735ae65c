"""Layout elements: cleaning, dropping, and the genre of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.functions import headings

# Kinds of elements, and those that are page furniture or repeat headings.
KINDS = ("title", "heading", "narrative", "list_item", "table", "figure", "page_header", "page_footer", "page_number", "other")
FURNITURE = ("page_header", "page_footer", "page_number")
#: Characters that the genre is told from.
SAMPLE_CHARS = 4000


def kept(elements: DataFrame, profile: headings.Profile | None = headings.MANUAL) -> DataFrame:
    """Elements with cleaned text, without blank and dropped ones; `pos` keeps the original order. None: see headings.under."""
    rows = elements.withColumn("text", headings.under(profile, lambda p: headings.clean(F.col("text"), p)))
    return rows.filter(~headings.under(profile, lambda p: headings.dropped(F.col("text"), p)))


def drop_counts(elements: DataFrame, profile: headings.Profile = headings.MANUAL) -> DataFrame:
    """(doc_id, n_elements, n_dropped)"""
    gone = headings.dropped(headings.clean(F.col("text"), profile), profile)
    return elements.groupBy("doc_id").agg(F.count("*").alias("n_elements"), F.count_if(gone).alias("n_dropped"))


def genres(elements: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, profile): told from the first elements until they have `chars` characters, the crossing one included."""
    order = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    full = elements.filter("text is not null and text != ''").withColumn("_before", F.coalesce(F.sum(F.length("text")).over(order), F.lit(0)))
    texts = full.filter(F.col("_before") < chars).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("_s"))
    told = texts.select("doc_id", headings.genre(F.array_join(F.transform("_s", lambda x: x["text"]), " ")).alias("profile"))
    return elements.select("doc_id").distinct().join(told, "doc_id", "left").select("doc_id", F.coalesce("profile", F.lit("manual")).alias("profile"))


def from_lines(docs: DataFrame, lines_a_page: int = 20) -> DataFrame:
    """Plain texts as elements, one a line: (doc_id, pos, page_number, physical_page_index, kind, text)."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    page = F.floor(F.col("pos") / lines_a_page).cast("int")
    return lines.select("doc_id", "pos", (page + 1).alias("page_number"), page.alias("physical_page_index"), F.lit("narrative").alias("kind"), "text")


