"""Looking up single documents, sections and questions, and whole trees, in tables of any size.

A lookup is a filter on a key, which reaches the Parquet scan. The store keeps each document's rows together and in order,
so row groups without the key are skipped by their statistics. Many keys at a time come as a table and are joined.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.functions.text import page_label, preview

# Marks of sections by level, of annexes and of deeper sections.
ICONS = ("📚", "📖", "📄", "•")
ANNEX, DEEPER = "📎", "·"


def pick(rows: DataFrame, key: str, wanted: int | str | Iterable | DataFrame) -> DataFrame:
    """Rows whose key is wanted: one value, some values, or a table with a column of that name. Null keys are never wanted."""
    if isinstance(wanted, DataFrame):
        return rows.join(wanted.select(key), key, "left_semi")
    if isinstance(wanted, (int, str)):
        return rows.filter(F.col(key) == wanted)
    return rows.filter(F.col(key).isin(list(wanted)))


def with_counts(nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """Sections with n_chunks, 0 where there are none."""
    n = chunks.groupBy("node_id").agg(F.count("*").alias("n_chunks"))
    return nodes.join(n, "node_id", "left").withColumn("n_chunks", F.coalesce("n_chunks", F.lit(0)))


def tree(nodes: DataFrame, chunks: DataFrame, doc_id: int) -> DataFrame:
    """A document's sections in order, with n_chunks; none for an unknown document."""
    return with_counts(pick(nodes, "doc_id", doc_id), pick(chunks, "doc_id", doc_id)).orderBy("sort_key", "node_id")


def section(nodes: DataFrame, chunks: DataFrame, node_id: int) -> DataFrame:
    """One section with n_chunks, or no row."""
    return with_counts(pick(nodes, "node_id", node_id), pick(chunks, "node_id", node_id))


def section_chunks(chunks: DataFrame, node_id: int) -> DataFrame:
    """A section's chunks in order."""
    return pick(chunks, "node_id", node_id).orderBy("ordinal")


def previews(chunks: DataFrame, size: int = 400) -> DataFrame:
    """Chunks with `preview` for `text`: the first characters, with a mark where there are more."""
    return chunks.withColumn("preview", preview(F.col("text"), size)).drop("text")


def cards(questions: DataFrame, options: DataFrame, nodes: DataFrame) -> DataFrame:
    """Questions with breadcrumb and pages of their section, and options (role, text) in their order.

    Of an unknown section both are null; without options the array is empty.
    """
    listed = options.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("order_in_question", "role", "text"))).alias("o"))
    last = F.when(F.col("page_end") == 0, None).otherwise(F.col("page_end"))
    where = nodes.select("node_id", "breadcrumb", page_label(F.col("page_start"), last).alias("pages"))
    each = F.transform(F.coalesce("o", F.expr("cast(array() as array<struct<order_in_question:int, role:string, text:string>>)")), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return questions.join(where, "node_id", "left").join(listed, "question_id", "left").withColumn("options", each).drop("o")


def label(extra: Column | None = None) -> Column:
    """How a section with n_chunks is shown: icon, kind and ordinal unless it is a part, title, chunks, and what is added."""
    icon = F.lit(DEEPER)
    for level, mark in reversed(tuple(enumerate(ICONS))):
        icon = F.when(F.col("level") == level, mark).otherwise(icon)
    named = F.when((F.col("level_label") != "") & (F.upper("level_label") != "PARTE"), F.concat(F.lit("**"), "level_label", F.lit(" "), F.coalesce("ordinal", F.lit("")), F.lit("**")))
    titled = F.when(F.col("title") != "", F.concat(F.when(named.isNotNull(), "— ").otherwise(""), "title"))
    counted = F.when(F.col("n_chunks") > 0, F.concat(F.lit("  ·  "), F.col("n_chunks").cast("string"), F.lit(" chunk(s)")))
    added = [] if extra is None else [F.when(extra != "", F.concat(F.lit("  ·  "), extra))]
    return F.concat_ws(" ", F.when(F.coalesce("is_anexo", F.lit(False)), ANNEX).otherwise(icon), named, titled, counted, *added)


def neighbours(nodes: DataFrame) -> DataFrame:
    """(doc_id, local_id, place, of, previous, next): a section among those under the same parent, in the document's order.

    One row a section, whatever the number of its siblings.
    """
    family = Window.partitionBy("doc_id", "parent_pos")
    order = family.orderBy("pos")
    return nodes.select("doc_id", "local_id", F.row_number().over(order).alias("place"), F.count("*").over(family).alias("of"), F.lag("local_id").over(order).alias("previous"), F.lead("local_id").over(order).alias("next"))
