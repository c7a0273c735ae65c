"""From elements to a filled store in one job for a whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium import shared
from folium.functions import headings
from folium.operators import chunking, contents, elements, hierarchy, quality
from folium.sources.store import Store


def sections(rows: DataFrame, profile: headings.Profile = headings.MANUAL, sizes: chunking.Sizes | None = None) -> tuple[DataFrame, DataFrame]:
    """Sections and chunks of elements under one profile."""
    marked = hierarchy.annotate(rows, profile)
    nodes = hierarchy.nodes(marked, profile)
    sizes = sizes or chunking.sizes_for(profile.name)
    return nodes, chunking.chunks(chunking.merged(nodes, hierarchy.body(marked), sizes.merge), sizes)


def told_sections(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections and chunks of elements annotated under each document's own profile; legal genres merge nothing."""
    nodes = hierarchy.nodes(annotated, None)
    nodes = nodes.join(annotated.select("doc_id", "profile").distinct(), "doc_id")
    merge = F.when(F.col("profile").startswith("manual"), chunking.MANUALS.merge).otherwise(chunking.LEGAL.merge)
    # genres differ in what they merge only, not in how texts are cut
    return nodes.drop("profile"), chunking.chunks(chunking.merged(nodes, hierarchy.body(annotated), merge), chunking.MANUALS)


def run(store: Store, documents: DataFrame, rows: DataFrame, prefer_contents: bool = False) -> DataFrame:
    """Each document by the profile that its beginning speaks for; returns the quality report.

    Headings are looked for once, over the whole corpus, and kept; sections, chunks and the report come from that. With
    prefer_contents a document in which a table of contents is found gets its sections from that, the others as before.
    """
    spark = store.spark
    told = rows.join(elements.genres(rows), "doc_id")
    if prefer_contents:
        told, path = shared.stored(told)
        found = contents.found_in(told)
        found, at = shared.stored(found)
        by_contents = contents.annotate(found, told.join(found.select("doc_id").distinct(), "doc_id", "left_semi"), None)
        by_body = hierarchy.annotate(told.join(found.select("doc_id").distinct(), "doc_id", "left_anti"), None)
        same = [c for c in by_contents.columns if c in by_body.columns]
        marked, where = shared.stored(by_body.select(*same).unionByName(by_contents.select(*same)))
        paths = [path, at, where]
    else:
        marked, where = shared.stored(hierarchy.annotate(told, None))
        paths = [where]
    nodes, chunks = told_sections(marked)
    (nodes, n), (chunks, c) = shared.stored(nodes), shared.stored(chunks)
    store.save_document(documents, nodes, chunks)
    for p in (*paths, n, c):
        shared.delete(spark, p)
    return quality.report(store.table("documents"), store.table("nodes"), store.table("chunks"))
