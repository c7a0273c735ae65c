import random

import numpy as np
from brute import near_groups
from pyspark.sql import functions as F

from folium.llm import near_dedup
from folium.llm.graph import components
from folium.llm.shingles import signatures


def family(seed, n, size=60, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 99999)}"
        out.append(" ".join(copy))
    return out


def check(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.group(docs, **how).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = [(i, n, c, i == c) for (i, _), (n, c) in zip(rows, near_groups(rows, how.get("size", 5)))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_against_brute_force(spark):
    texts = family(1, 40) + family(2, 5) + family(3, 12, 12, 2) + ["", None, " \t", "one", "One", "two words", "TWO\x0bwords", "É b", "é b"]
    rows = [(100 - k if k % 7 else 300 + k, t) for k, t in enumerate(texts)]
    check(spark, rows, size=2)
    check(spark, rows)


def test_blocks_without_leaders_help(spark, monkeypatch):
    """Buckets with several components and blocks give the links that leaders miss."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    rows = list(enumerate(family(4, 60, 40, 9)))
    check(spark, rows, size=2)


def test_nulls_repeats_empty_and_clashing(spark):
    assert near_dedup.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check(spark, [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (1, "q r s"), (1, "t u v")], size=2)
    docs = spark.createDataFrame([(3, "a b c d e f", "x", 1), (3, "a b c d e f", "x", 2), (None, "a b c d e f", "y", 3), (9, None, "z", 4), (None, "", "z", 5)], "doc_id long, text string, cid string, key int")
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 9]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        a = rng.integers(0, 2**63, 400).astype(np.uint64)
        b = np.concatenate([a[: int(400 * 2 * share / (1 + share))], rng.integers(0, 2**63, 400).astype(np.uint64)])[:400]
        s = signatures([np.unique(a), np.unique(b)], 1024)
        assert abs((s[0] == s[1]).mean() - share) < 0.06
    tiny = signatures([np.array([5], np.uint64), np.array([5, 9], np.uint64), np.empty(0, np.uint64)], 64)
    assert np.isfinite(tiny[:2]).all() and np.isinf(tiny[2]).all()
    assert (np.sort(np.floor(tiny[0])) == np.arange(64)).all()


def test_components_of_long_chains(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1) if i % 50 != 49]
    name = lambda k: b"%05d" % k
    frame = spark.createDataFrame([(name(a), name(b)) for a, b in links], "a binary, b binary").repartition(4)
    got = {bytes(r["node"]): bytes(r["root"]) for r in components(frame).collect()}
    for k in range(0, n, 50):
        part = order[k : k + 50]
        assert {got[name(x)] for x in part} == {name(min(part))}
    assert components(frame.limit(0)).count() == 0


def test_sifting_keeps_all_found_keys_and_little_else(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id", "unhex(md5(string(id))) as key")
    found = rows.filter("id % 40 = 0").select(F.col("key").alias("cid"))
    for most, extra in ((1 << 27, 300), (1 << 15, 300)):
        monkeypatch.setattr(near_dedup, "SIFT_MOST", most)
        got = {r["id"] for r in near_dedup.sifted(rows, "key", found, "cid").collect()}
        assert set(range(0, 4000, 40)) <= got and len(got) <= 100 + extra
    assert near_dedup.sifted(rows, "key", found.limit(0), "cid").count() == 0


def test_texts_that_meet_no_other_are_not_dealt_out(spark, tmp_path):
    """With broadcast joins out of the way, as on large tables, shuffles move far less than the texts."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(3000)) for _ in range(150)]
    rows = [(k, t) for k, t in enumerate([*texts, texts[7] + " more"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    none = gateway.new_array(gateway.jvm.double, 0)

    def stages():
        found = store.stageList(None, False, False, none, None)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in map(found.apply, range(found.size()))}

    before = dict.fromkeys(stages(), 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.group(docs, size=2).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {k: 7 if k == 150 else k for k in range(151)}
    moved = sum(v for k, v in stages().items() if before.get(k) is None)
    assert moved < 0.5 * sum(map(len, texts)), (moved, sum(map(len, texts)))
