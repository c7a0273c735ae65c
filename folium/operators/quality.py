"""Reports on ingested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.functions.text import match_key


def level_distribution(nodes: DataFrame) -> DataFrame:
    """(doc_id, level_label, n) of sections."""
    return nodes.groupBy("doc_id", "level_label").agg(F.count("*").alias("n"))


def leaves(nodes: DataFrame) -> DataFrame:
    """Sections that are nobody's parent."""
    parents = nodes.filter("parent_pos is not null").select("doc_id", F.col("parent_pos").alias("pos")).distinct()
    return nodes.join(parents, ["doc_id", "pos"], "left_anti")


def report(documents: DataFrame, nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row a document (doc_id, page_count): sections, chunks, orphans, pages covered, share covered, mean size.

    Orphans are sections without a chunk of their own. Pages are those of all chunks' ranges, ends included, each
    once; an inverted range covers none. The share is not cut at 100. Counts are 0 where there is nothing.
    """
    by_node = nodes.join(chunks.groupBy("doc_id", "local_id").agg(F.count("*").alias("own")), ["doc_id", "local_id"], "left")
    n = by_node.groupBy("doc_id").agg(F.count("*").alias("n_nodes"), F.count_if(F.col("own").isNull()).alias("orphan_nodes"))
    c = chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), (F.sum("char_count") / F.count("*")).alias("avg_chunk_chars"))
    ranges = chunks.filter("page_end >= page_start").select("doc_id", "page_start", "page_end").distinct()
    pages = ranges.select("doc_id", F.explode(F.sequence("page_start", "page_end")).alias("p")).distinct().groupBy("doc_id").agg(F.count("*").alias("pages_covered"))
    out = documents.select("doc_id", "page_count").join(n, "doc_id", "left").join(c, "doc_id", "left").join(pages, "doc_id", "left")
    zero = lambda x: F.coalesce(x, F.lit(0))
    share = F.when(F.col("page_count") > 0, 100.0 * zero("pages_covered") / F.col("page_count")).otherwise(0.0)
    return out.select("doc_id", zero("n_nodes").alias("n_nodes"), zero("n_chunks").alias("n_chunks"), zero("orphan_nodes").alias("orphan_nodes"), zero("pages_covered").alias("pages_covered"), share.alias("coverage_pct"), F.coalesce("avg_chunk_chars", F.lit(0.0)).alias("avg_chunk_chars"))


def extraction_metrics(elements: DataFrame, nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, n_elements, n_headings, n_tables, n_leaves, n_chunks): what extractors are compared by."""
    e = elements.groupBy("doc_id").agg(F.count("*").alias("n_elements"), F.count_if(F.col("kind").isin("title", "heading")).alias("n_headings"), F.count_if(F.col("kind") == "table").alias("n_tables"))
    out = e.join(leaves(nodes).groupBy("doc_id").agg(F.count("*").alias("n_leaves")), "doc_id", "left").join(chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks")), "doc_id", "left")
    return out.fillna(0, ["n_leaves", "n_chunks"])


def contents_gaps(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, side, title): contents entries without a section of that title, and sections that no entry names."""
    left = entries.select("doc_id", match_key(F.col("title")).alias("key"), "title")
    right = nodes.select("doc_id", match_key(F.col("title")).alias("key"), "title").filter("key != ''")
    missing = left.join(right.select("doc_id", "key").distinct(), ["doc_id", "key"], "left_anti").select("doc_id", F.lit("contents").alias("side"), "title")
    extra = right.join(left.select("doc_id", "key").distinct(), ["doc_id", "key"], "left_anti").select("doc_id", F.lit("body").alias("side"), "title")
    return missing.unionByName(extra)


def symbol_frequencies(pages: DataFrame, limit: int = 15) -> DataFrame:
    """(symbol, n): the commonest characters that are neither letters, digits nor white space; ties by code point."""
    symbols = pages.select(F.explode(F.split(F.regexp_replace("text", r"(?U)[\w\s&&[^_]]", ""), "")).alias("symbol")).filter("symbol != ''")
    return symbols.groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(limit)


def markdown(metrics: DataFrame, title: str = "Extraction", limit: int = 1000) -> str:
    """A table of a few documents' metrics as text."""
    rows = metrics.orderBy(metrics.columns[0]).limit(limit).collect()
    lines = [f"# {title}", "", "| " + " | ".join(metrics.columns) + " |", "|" + "---|" * len(metrics.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"
