"""A training corpus from raw documents: languages, near copies, repeated strings, source weights, token ids.

Every stage works on whole texts of any length, keeps rows whose id or other columns are null, treats repeated rows
as rows like others unless it says otherwise, gives no rows for none, and takes columns of any names; each but the
last returns the columns that it got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.llm import bpe, language_id, mixing, near_dedup, scratch, suffix_dedup
from folium.llm.columns import numbered
from folium.llm.queries import word_vocabulary


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin; texts that are null or without letters go."""
    rows, text = numbered(docs), f"c{docs.columns.index('text')}"
    found = language_id.identify(rows, language_id.dictionaries(docs), text, tuple(rows.columns))
    return found.filter("accepted").select(*rows.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles and a similarity of 0.8; of repeated rows one.

    Texts that are null or without words are in no group and stay.
    """
    return near_dedup.one_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that stand elsewhere too; n_chars follows the text. Null texts stay null."""
    rows, at = numbered(docs), docs.columns.index("text")
    rows = rows.withColumn("null_text", F.col(f"c{at}").isNull())
    others = [c for k, c in enumerate(rows.columns) if k != at]
    left = suffix_dedup.without_repeats(rows, f"c{at}", keep=tuple(others), with_text=True)
    left = left.withColumn(f"c{at}", F.when(~F.col("null_text"), F.col("kept_text")))
    if "n_chars" in docs.columns:
        left = left.withColumn(f"c{docs.columns.index('n_chars')}", F.length(f"c{at}").cast(docs.schema["n_chars"].dataType))
    return left.select(*(f"c{k}" for k in range(len(docs.columns)))).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in a global random order; a null source is one of its own."""
    mixed = numbered(mixing.mix(docs))
    return mixed.select(*(f"c{k}" for k in range(len(docs.columns)))).toDF(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of each text, and a digest of what they decode to; a null text has no ids."""
    return bpe.encode(docs, word_vocabulary()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", remove_repeats),
    ("source_mix", mix_sources),
    ("bpe", encode_texts),
]

#: Compression, signatures and merges have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's tables are deleted once the next has been written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = scratch.kept()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.Scratch(spark).keep(docs)
            scratch.close(spark, since, docs)
    return docs
