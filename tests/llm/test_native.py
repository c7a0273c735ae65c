import itertools
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from folium.llm import mixing, quality_rules, queries, scratch, sharding, url_filter

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    frame = queries.queries()[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = sorted(map(repr, map(tuple, frame.select(*columns).collect())))
    want = sorted(map(repr, con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()))
    assert got == want


def test_no_python_in_native_plans(spark):
    for name in ("op3_url_filter", "op5_quality_rules", "op7_sharding"):
        plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
        ("http://x.net", "x.net", "", None, None),
        ("http://x.net/", "x.net", "/", "net/", "block"),
        ("x://y.org/fr/a://b", "y.org", "/fr/a://b", "org/fr/", "allow"),
        ("http://h?x/y", "h", "", None, None),
        ("no scheme/net/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
    ]
    pages = spark.createDataFrame([(k, c[0], "clash") for k, c in enumerate(cases)], "page_id long, url string, rule string")
    rows = url_filter.ruled(pages).orderBy("page_id").collect()
    assert [(r["url"], r["host"], r["path"], r["rule"], r["ruled"]) for r in rows] == cases


def test_url_models_learn_and_edges(spark):
    rows = [(k, f"http://{'good' if k % 2 else 'evil'}{k % 17}.test/{k}", ) for k in range(200)]
    rules = {("test", "/1"): "allow"}
    assert {r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()} <= {"allow", "block"}
    taught = [(k, f"http://{'good.nice' if k % 2 else 'evil.vile'}/{k}") for k in range(100)] + [(100 + k, f"http://{'goodly.new' if k % 2 else 'evilest.new'}/{k}") for k in range(40)] + [(None, None), (None, None)]
    judged = url_filter.judge(spark.createDataFrame(taught, "page_id long, url string"), rules={("nice", "/"): "allow", ("vile", "/"): "block"}).collect()
    assert len(judged) == 142
    new = [r for r in judged if r["host"].endswith(".new")]
    assert all((r["verdict"] == "allow") == r["host"].startswith("good") for r in new)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_measures(spark):
    text = "a b c d e x a b c d e\n\n#$ q\n#$ q\n \t\n \t"
    docs = spark.createDataFrame([(1, text, "s"), (2, None, None), (None, "", "s"), (3, "\u00a0 é\x0bü", "s")], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in quality_rules.measures(docs).collect()}
    assert [rows[1][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")] == [15, 17, 4, 1, 10, 3]
    assert rows[3]["n_words"] == 3 and rows[2]["n_words"] == rows[None]["n_words"] == 0


def test_repeated_words_against_brute_force(spark):
    import random

    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 4, 5, 6, 30, 100, 400)] + ["k " * 5000]
    rows = quality_rules.measures(spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        w = t.split()
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        covered = {i + k for i, x in enumerate(runs) if runs.count(x) > 1 for k in range(5)} if len(w) < 1000 else set(range(len(w)))
        assert r["n_repeat_words"] == len(covered)


def test_hosts_decide(spark):
    good = "many different words make this text quite long and readable for everyone here".split()
    rows = [(k, " ".join(good[k % 5 :] + good[: k % 5]), "good") for k in range(30)] + [(100 + k, "# " * 40, "bad") for k in range(30)] + [(200, " ".join(good), "bad"), (201, " ".join(good), None)]
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0]["kept"] and not got[100]["kept"] and not got[200]["kept"] and got[201]["kept"] and not got[200]["base_failed"]
    assert quality_rules.judge(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_mixing(spark):
    rows = [(k, "a" if k % 4 else "b", "t") for k in range(4000)] + [(None, None, None), (None, None, None), (1, "a", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, copy string")
    got = mixing.mix(docs, weights={"a": 1, "b": 3}).collect()
    by = {s: sum(r["source"] == s for r in got) for s in ("a", "b", None)}
    assert abs(by["b"] / 3000 - 1) < 0.1 and abs(by["a"] / 1000 - 1) < 0.15 and by[None] == 0
    for key, copies in itertools.groupby(sorted(((r["doc_id"], r["copies"], r["copy_"]) for r in got if r["doc_id"] != 1)), lambda r: r[:2]):
        assert [c for _, _, c in copies] == list(range(1, key[1] + 1))
    places = [r["place"] for r in got]
    assert places == sorted(places)
    assert mixing.mix(docs.limit(0)).count() == 0
    even = mixing.mix(docs, weights={"a": 1, "b": 1}, size=50).groupBy("source").count().collect()
    assert all(abs(r["count"] / (4003 * 25) - 1) < 0.05 for r in even)
    assert mixing.mix(docs, weights={"zz": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": -1})


def test_poisson_shares(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "'s' as source")
    got = {r["copies"]: r["n"] for r in mixing.mix(docs).filter("copy = 1").groupBy("copies").agg(F.count("*").alias("n")).collect()}
    for k in (1, 2, 3):
        assert abs(got[k] / 20000 - math.exp(-1) / math.factorial(k)) < 0.012


@pytest.mark.parametrize("group", [4096, 37])
def test_null_and_repeated_ids_are_drawn_one_by_one(spark, group, monkeypatch):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", group)
    equal = spark.range(2000).selectExpr("cast(null as long) as doc_id", "'s' as source", "'same' as text")
    other = spark.range(2000).selectExpr("7L as doc_id", "'s' as source", "concat('text ', id) as text")
    got = mixing.mix(equal.unionByName(other).repartition(6)).filter("copy = 1").collect()
    for rows in ([r for r in got if r["text"] == "same"], [r for r in got if r["doc_id"] == 7]):
        drawn = Counter(r["copies"] for r in rows)
        assert all(abs(drawn[k] / 2000 - math.exp(-1) / math.factorial(k)) < 0.04 for k in (1, 2, 3))
        assert len({r["place"] for r in rows}) == len(rows)
    again = mixing.mix(other.unionByName(equal).repartition(3)).filter("copy = 1").collect()
    assert sorted(r["place"] for r in again) == sorted(r["place"] for r in got)


def test_equal_rows_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 10)
    rows = [(None, None)] * 95 + [(None, "")] * 3 + [(1, "n")] + [(1, "v")] * 2
    found = mixing._numbered_equals(spark.createDataFrame(rows, "c0 int, c1 string").repartition(4)).collect()
    got = sorted((repr(r["c0"]), repr(r["c1"]), r["number"]) for r in found)
    want = [*(("None", "None", k) for k in range(1, 96)), *(("None", "''", k) for k in range(1, 4)), ("1", "'n'", 0), ("1", "'v'", 1), ("1", "'v'", 2)]
    assert got == sorted(want)


@pytest.mark.parametrize("name", ["host", "t", "n_words", "rate", "c0", "source"])
def test_a_host_column_of_any_name(spark, name):
    docs = spark.createDataFrame([(1, "a few plain words that are read here and there now", "h"), (2, None, None)], f"doc_id long, text string, `{name}` string")
    found = quality_rules.judge(docs, host=name)
    assert found.columns[:2] == ["doc_id", name] and sorted(r[1] or "" for r in found.collect()) == ["", "h"]


def test_shards_round_trip_and_versions(spark):
    store = sharding.ShardStore(spark, scratch.folder(spark), target=4000)
    rows = [(k, "x" * (k % 50), None if k % 3 else "s") for k in range(600)] + [(None, None, None), (5, "dup", "s"), (5, "dup", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    size = F.octet_length(F.coalesce("text", F.lit("")))
    assert store.version() == 0
    assert store.append(docs.filter("doc_id < 300 or doc_id is null"), sharding.arrival_of(F.col("doc_id"), 20), size) == 1
    before = sorted(map(repr, store.read(1).select("doc_id", "text").collect()))
    assert store.append(docs.filter("doc_id >= 300"), sharding.arrival_of(F.col("doc_id"), 20), size) == 2
    assert store.compact() == 3
    want = sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert sorted(map(repr, store.read().select("doc_id", "text").collect())) == want
    assert sorted(map(repr, store.read(1).select("doc_id", "text").collect())) == before
    live = store.manifest().collect()
    assert sum(r["n"] for r in live) == 603 and all(r["size"] <= 4000 + 2000 for r in live)
    assert len(live) < store.manifest(2).count()
    while (version := store.version()) != store.compact():
        assert store.version() == version + 1
    with pytest.raises(Exception, match="(?i)exist"):
        store._commit(store.manifest(), 0)


def test_large_arrivals_get_files_of_target_size(spark):
    assert sharding.TARGET_BYTES == 128 << 20
    store = sharding.ShardStore(spark, scratch.folder(spark), target=4000)
    rows = [(None, "x" * 50)] * 400 + [(1, "y" * 100)] * 30 + [(40, "z"), (60, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert store.append(docs, sharding.arrival_of(F.col("doc_id"), 20), F.octet_length("text")) == 1
    assert store.compact() == 2
    folder = {r["folder"] for r in store.manifest().collect()}.pop()
    files = store._read([folder]).select("row.text", "shard", F.col("_metadata.file_path").alias("f")).groupBy("shard", "f").agg(F.sum(F.length("text")).alias("size")).collect()
    sizes = {k: sorted(r["size"] for r in files if r["shard"] == k) for k in ("-1-v1", "0-v1")}
    assert {r["folder"] for r in store.manifest().collect()} == {folder}
    assert len(sizes["-1-v1"]) == 5 and max(sizes["-1-v1"]) < 8000 and sizes["0-v1"] == [3000]
    assert len({r["f"] for r in files}) == len(files) == 7
    want = sorted(map(repr, docs.collect()))
    assert sorted(map(repr, store.read().select("doc_id", "text").collect())) == want
    assert store.compact() == 2


def test_empty_store(spark):
    store = sharding.ShardStore(spark, scratch.folder(spark))
    empty = spark.createDataFrame([], "doc_id long, text string, shard int")
    assert store.append(empty, sharding.arrival_of(F.col("doc_id")), F.length("text")) == 1
    assert store.compact() == 1 and store.manifest().count() == 0
    assert store.read().count() == 0 and store.read().columns == ["doc_id", "text", "shard", "n_bytes", "shard_"]


def test_stores_keep_columns_of_any_name(spark):
    store = sharding.ShardStore(spark, scratch.folder(spark), target=4000)
    docs = spark.createDataFrame([(k, "x" * 50, f"s{k}", None if k % 2 else k) for k in range(100)], "doc_id long, text string, shard string, `n_bytes` int")
    store.append(docs, sharding.arrival_of(F.col("doc_id"), 10), F.octet_length("text"))
    store.compact()
    assert sorted(map(repr, store.read().select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    # an arrival's rows come together before they are written
    folder = {r["folder"] for r in store.manifest(1).collect()}.pop()
    files = store._read([folder]).select(F.col("_metadata.file_path").alias("f"), "shard").distinct()
    assert files.count() == 10 and files.select("shard").distinct().count() == 10
