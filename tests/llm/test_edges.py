"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folium.llm import attention, bpe, language_id, lm_scoring, mixing, near_dedup, nearest, quality_model, quality_rules, scratch, sharding, suffix_dedup, url_filter
from folium.llm.queries import word_vocabulary

SMALL = "/root/testdata/sf0.001"
#: Names that the operators use inside or add.
CLASHES = "src parts _parts cdf rate copy copies place score accepted lang_pred _id id tid cid sid key keys root many of own_tid null_text _null kept_text n_removed n_spans spans ids decoded shard n_bytes row held_out base_score n_words kept host rule verdict list query_id rank c0 c1".split()


def long_text():
    rng = random.Random(9)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(40_000))


@pytest.fixture(scope="module")
def table(spark):
    words = "some plain words that stand here and stay here for a while".split()
    rows = [(None, None, None, None, None), (None, "", "en", None, 0), (1, " \t\n", "en", "s", 3), (2, " ".join(words), "en", "s", 59), (2, " ".join(words), "en", "s", 59), (3, "kurze worte die hier nicht bleiben", "de", "t", 34), (4, long_text(), "en", "s", 1), (5, "x" * 150_000, "de", "t", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(CLASHES):
        frame = frame.withColumn(name, F.lit(k) if k % 2 else F.lit(f"v{k}"))
    return frame


def op7(docs):
    store = sharding.ShardStore(docs.sparkSession, scratch.folder(docs.sparkSession))
    store.append(docs, sharding.arrival_of(F.col("doc_id")), F.octet_length(F.coalesce("text", F.lit(""))))
    store.compact()
    return store.read()


OPERATORS = {
    "op1": suffix_dedup.without_repeats,
    "op2": near_dedup.group,
    "op3": lambda d: url_filter.judge(d.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "url")),
    "op4": lambda d: lm_scoring.score(d, language_id.fold(F.col("doc_id"), 5) == 1, word_vocabulary()),
    "op5": quality_rules.judge,
    "op6": lambda d: language_id.identify(d, language_id.dictionaries(d)),
    "op7": op7,
    "op12": lambda d: quality_model.score(d, d.sparkSession.createDataFrame([(2, 1), (3, 0)], "doc_id long, quality int"), F.lit(True)),
    "op9": lambda d: bpe.digests(bpe.encode(d, word_vocabulary())),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_give_a_row_for_each_row(table, name, monkeypatch):
    monkeypatch.setattr(attention, "EPOCHS", 1)
    out = OPERATORS[name](table)
    assert len(out.collect()) == 8
    assert OPERATORS[name](table.limit(0)).count() == 0


def test_mixing_keeps_clashing_columns(table):
    out = mixing.mix(table, weights={"s": 1, "t": 1, None: 1}, size=30)
    assert out.columns[: len(table.columns)] == table.columns and out.columns[-4:] == ["copy_", "copies_", "rate_", "place_"]
    assert {r["copy"] for r in out.select("copy").collect()} == {CLASHES.index("copy")}
    assert mixing.mix(table.limit(0)).count() == 0


def test_nearest_takes_clashing_columns(spark):
    rows = spark.range(300).selectExpr("id as vec_id", "array(double(id % 17), double(id % 5), 1d) as embedding", *(f"'x' as `{c}`" for c in CLASHES))
    assert nearest.search(rows, F.col("vec_id") % 100 == 0).count() == 30
    assert nearest.search(rows.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES])
def test_stages(spark, table, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, table, SMALL)
    rows = out.collect()
    assert name == "bpe" or out.columns == table.columns
    number = {"language_id": 4, "near_dedup": 7, "suffix_dedup": 8, "bpe": 8}
    assert len(rows) == number.get(name, len(rows))
    if name in ("language_id", "near_dedup", "suffix_dedup"):
        assert {(r["copy"], r["src"], r["_many" if "_many" in out.columns else "many"]) for r in rows} == {(CLASHES.index("copy"), "v0", CLASHES.index("many") if CLASHES.index("many") % 2 else f"v{CLASHES.index('many')}")}
    assert stage(spark, table.limit(0), SMALL).count() == 0
