import hashlib

import pytest
from brute import near_groups, without_repeats

import corpus_pipeline
from folium.llm import bpe, language_id, mixing
from folium.llm.queries import word_vocabulary

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}
    judge = language_id.Compressors(language_id.dictionaries(docs)).judge
    clear = [(i, r["text"]) for i, r in sorted(rows.items()) if (v := judge(r["text"]))[0] != "und" and v[1] >= language_id.MIN_MARGIN]
    one = stages["language_id"](spark, docs, SMALL)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == [i for i, _ in clear]
    assert len(clear) >= 0.95 * len(rows)
    single = [(i, t) for (i, t), (_, c) in zip(clear, near_groups(clear, 5)) if i == c]
    two = stages["near_dedup"](spark, one, SMALL)
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == [i for i, _ in single]
    three = {r["doc_id"]: r for r in stages["suffix_dedup"](spark, two, SMALL).collect()}
    left = {i: x for (i, _), x in zip(single, without_repeats([t for _, t in single], 200))}
    assert three.keys() == left.keys()
    assert all(len(r["text"].encode()) >= left[i][0] - left[i][1] - 8 * left[i][2] for i, r in three.items())
    whole = [i for i, r in three.items() if r["text"].isascii() and rows[i]["text"].isascii()]
    assert all(hashlib.sha256(three[i]["text"].encode()).hexdigest() == left[i][3] and three[i]["n_chars"] == len(three[i]["text"]) for i in whole)
    final = corpus_pipeline.run(spark, SMALL).collect()
    frame = spark.createDataFrame(list(three.values()), docs.schema)
    drawn = mixing.mix(frame, shuffled=False).collect()
    assert sorted(r["doc_id"] for r in final) == sorted(r["doc_id"] for r in drawn)
    known = bpe.encoder(word_vocabulary())
    for r in final:
        assert r["ids"] == known.encode(three[r["doc_id"]]["text"]) and r["n_tokens"] == len(r["ids"])


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_take_nulls_and_empty_tables(spark, name):
    schema = "doc_id long, text string, lang string, source string, n_chars long, cid string, tid int"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, "x", 1), (2, "some words that stay here", "en", "s", 25, "x", 1), (2, "some words that stay here", "en", "s", 25, "x", 1)]
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(rows, schema)
    out = stage(spark, docs, SMALL)
    assert name == "bpe" or out.columns == docs.columns
    assert out.count() <= 12
    assert stage(spark, docs.limit(0), SMALL).count() == 0
