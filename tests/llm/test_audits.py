"""Source divergences, the quality model and the filter audit against plain versions."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from folium.llm import divergence, filter_audit, quality_model
from folium.llm.queries import op12_quality_model

SMALL = "/root/testdata/sf0.001"
CLASHES = "term docs n cells at cell p q base held total terms lang_n value rank item part mask good toxic key digest id first t w c0 c1 score predicted pooled y h A E".split()


def plain_divergences(rows, min_docs, top=10):
    """Rows of (lang, source, text) to (lang, source, part, item, value, rank), term by term and pair by pair."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        counts, docs = defaultdict(Counter), Counter()
        for _, source, text in (r for r in rows if r[0] == lang):
            found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
            counts[source].update(found)
            docs.update(set(found))
        terms = [t for t, n in docs.items() if n >= min_docs]
        kept = {s: {t: c[t] for t in terms} for s, c in counts.items()}
        whole = {t: sum(c[t] for c in kept.values()) for t in terms}
        share = lambda c: {t: 1 + 1_000_000_000 * (n + 2) // (sum(c.values()) + 2 * len(terms)) for t, n in c.items()}
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        shares, q = {s: share(c) for s, c in kept.items()}, share(whole)
        for s in kept:
            lists = {"pair": [(o, sum(gap(shares[s][t], shares[o][t]) for t in terms)) for o in kept if o != s]}
            lists["term"] = [(t, gap(shares[s][t], q[t])) for t in terms if kept[s][t] and shares[s][t] > q[t]]
            for part, found in lists.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k) for k, x in enumerate(found[: top if part == "term" else None], 1)]
    return sorted(out)


def random_rows(n=400):
    rng = random.Random(4)
    words = ["Ab", "ab", "çé", "x1y", "日本", "thé-à", "Zz", "q", "🙂", "\x00w", "word", "other"]
    rows = [(rng.choice(["en", "en", "en", "fr", None]), rng.choice(["s0", "s0", "s1", "é", "", None]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(n)]
    return [*rows, ("de", "s0", None), ("de", "s1", ""), ("it", "alone", "solo"), *[("en", "s0", "ab ab word")] * 200]


def with_clashes(frame):
    for k, name in enumerate(CLASHES):
        if name.lower() not in {c.lower() for c in frame.columns}:
            frame = frame.withColumn(name, F.lit(k))
    return frame


@pytest.mark.parametrize("memory", [divergence.MEMORY, 3000])
def test_divergences(spark, memory, monkeypatch):
    monkeypatch.setattr(divergence.stripes, "__defaults__", (divergence.MIN_DOCS, memory))
    rows = random_rows()
    frame = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    got = sorted(tuple(r) for r in divergence.audit(with_clashes(frame)).collect())
    want = plain_divergences(rows, divergence.MIN_DOCS)
    assert got == want and {r[0] for r in want} == {"", "en", "fr", "de"}
    assert [r for r in got if r[0] == "de"] == [("de", "s0", "pair", "s1", 0, 1), ("de", "s1", "pair", "s0", 0, 1)]


def test_no_divergences(spark):
    out = divergence.audit(spark.createDataFrame([], "lang string, source string, text string"))
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_terms_of_long_texts():
    text = ("Été thé x" * 300_000 + "y" * (3 << 20)).encode()
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.decode().translate(LOWER))
    assert divergence.term_counts(text) == Counter(x.encode() for x in want)


def test_pairs_are_handed_on_in_parts():
    rng = np.random.default_rng(3)
    cells = [[{"source": f"s{k}", "p": int(rng.integers(1, 10**9)), "base": int(rng.integers(1, 1000))} for k in rng.permutation(9)[: rng.integers(1, 9)]] for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array([f"l{k % 2}" for k in range(200)]), pa.array(cells)], ["lang", "cells"])
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    want = Counter()
    for k, stripe in enumerate(cells):
        for x, y in itertools.combinations(sorted(stripe, key=lambda c: c["source"]), 2):
            want[f"l{k % 2}", x["source"], y["source"]] += gap(x["p"], y["p"]) - gap(x["p"], y["base"]) - gap(x["base"], y["p"]) + gap(x["base"], y["base"])
    got = Counter()
    for found in divergence._pair_sums(iter([batch.slice(0, 70), batch.slice(70)])):
        for r in found.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["value"]
    assert got == want


def plain_audit(rows, filters):
    """Rows of (part, failed filters, good, toxic); every document goes through every order."""
    out = defaultdict(lambda: [0] * 7)
    for order in map("".join, itertools.permutations(filters)):
        for part, fails, good, toxic in rows:
            gone = False
            for step, f in enumerate(order, 1):
                here, row = f in fails, out[part or "", order, step]
                row[0] += not gone and not here
                row[1] += not gone and here
                row[2] += gone and here
                row[3] += fails == {f}
                row[4] += bool(not gone and here and good)
                row[5] += bool(not gone and here and toxic)
                gone = gone or here
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row[1]
    return sorted((*k, *v[:6], shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


@pytest.mark.parametrize("filters", ["A", "BA", "ABCDE"])
def test_filter_audit(spark, filters):
    rng = random.Random(len(filters))
    rows = [(rng.choice(["s", "t", None]), {f for f in filters if rng.random() < 0.3}, rng.random() < 0.5, rng.choice([True, False, None])) for _ in range(150)]
    columns = ", ".join(["part string", *(f"{f} boolean" for f in filters), "good boolean, toxic boolean"])
    frame = spark.createDataFrame([(p, *(True if f in x else rng.choice([False, None]) for f in filters), g, t) for p, x, g, t in rows], columns)
    frame = frame.withColumns({c: F.lit("x") for c in ("mask", "n", "c0", "filter_order", "kept")})
    got = sorted(tuple(r) for r in filter_audit.audit(frame, filters).collect())
    assert got == plain_audit(rows, filters)
    assert filter_audit.audit(frame.limit(0), filters).count() == 0


def test_filters_are_checked(spark):
    for wrong in ("", "AA", "ABCDEFGH"):
        with pytest.raises(ValueError):
            filter_audit.audit(spark.range(1), wrong)


def test_failures(spark):
    plain = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", " \t", plain, plain, plain, "a " * 60, plain + "X" * 40, plain + " 5%", "É" * 3 + plain, plain]
    ids = [1, 2, None, 9, 5, 5, 7, 8, 10, 11, None]
    docs = with_clashes(spark.createDataFrame(list(zip(ids, texts, "sstttttttt" + "\0")), "doc_id long, text string, source string"))
    docs = docs.withColumn("source", F.when(F.col("source") != "\0", F.col("source")))
    labels = spark.createDataFrame([(1, 1, 0), (5, None, 1), (5, 1, None), (7, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = Counter(("".join(f for f in "ABCDE" if r[f]), r["part"], r["good"], r["toxic"]) for r in filter_audit.failures(docs, labels).collect())
    want = [("A", "s", True, False), ("AE", "s", None, None), ("A", "t", None, None), ("E", "t", None, None), *[("", "t", True, True)] * 2, ("B", "t", False, False), ("C", "t", None, None), ("D", "t", None, None), ("", "t", None, None), ("", "", None, None)]
    assert got == Counter(want)
    assert filter_audit.failures(docs.limit(0), labels).count() == 0 and filter_audit.failures(docs, labels.limit(0)).count() == len(texts)


def plain_words(text):
    """The words of the quality model, with the marks before them."""
    out, last = [], None
    for found in re.finditer(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|([!-/:-@\[-`{-~])\1*", text):
        w = found.group()
        low = w.translate(LOWER)
        out += ["<shout>"] * (len(w.encode()) > 1 and re.fullmatch("[A-Z]+", w) is not None) + ["<again>"] * (low == last) + [low]
        last = low
    return out


def test_words_of_the_quality_model():
    texts = ["THAT THAT!! that", "That that x", "", "A1 b22 ü!?!!", "é É", "x"]
    raw = [t.encode() for t in texts]
    buckets, rows = quality_model.words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    want = [plain_words(t) for t in texts]
    assert np.diff(rows).tolist() == [len(w) for w in want]
    known = {}
    for word, bucket in zip(itertools.chain(*want), buckets.tolist(), strict=True):
        assert known.setdefault(word, bucket) == bucket
    assert len(set(known.values())) == len(known)


def test_word_vectors_and_pools(spark):
    """Sums of surroundings and pooled texts, word by word; one text is read in pieces."""
    texts = ["a b c a", None, "", "b THE! b b", "c " * 5]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    index = quality_model.index_vectors()
    assert np.abs(index).sum(axis=1).max() <= quality_model.NONZERO
    want = np.zeros((quality_model.BUCKETS, quality_model.DIMS + 1), np.int64)
    for t in filter(None, texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        b = quality_model.words(raw, np.array([0, len(raw)]))[0].tolist()
        for i, x in enumerate(b):
            want[x, -1] += 1
            for j in range(max(0, i - quality_model.REACH), min(len(b), i + quality_model.REACH + 1)):
                want[x, :-1] += index[b[j]]
    sums = [(r["bucket"], r["sums"]) for r in quality_model.word_sums(docs).collect()]
    assert len({b for b, _ in sums}) == len(sums) == np.count_nonzero(want[:, -1])
    assert all(want[b].tolist() == s for b, s in sums)
    vectors = quality_model.word_vectors(sums)
    long = "b THE! " * 200_000
    batch = pa.RecordBatch.from_arrays([pa.array([3, 4, None]), pa.array([texts[3], long, None])], ["doc_id", "text"])
    shared = type("Shared", (), {"value": vectors})
    found = next(quality_model._pooled(shared, 1, 1)(iter([batch]))).column(1).to_pylist()
    for text, got in zip((texts[3], long), found):
        raw = np.frombuffer(text.encode(), np.uint8)
        v = vectors[quality_model.words(raw, np.array([0, len(raw)]))[0]].astype(float)
        assert np.allclose(got, [*v.mean(axis=0), *v.std(axis=0), np.log1p(len(v))], atol=1e-4)
    assert found[2] == [0.0] * (2 * quality_model.DIMS + 1)


def test_quality_is_learned(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = op12_quality_model(spark, "/root/testdata/sf0.01").collect()
    held = {r["doc_id"]: r for r in rows if r["held_out"]}
    judged = [(held[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in held]
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    good, bad = ([r["score"] for r, q in judged if q == k] for k in (1, 0))
    assert len(bad) > 5 and np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] == q for r, q in judged]) > 0.95


def test_quality_edges(spark):
    texts = [None, "", "plain words here", "SHOUT!! SHOUT!!", "plain words here", "y" * 200_000]
    docs = with_clashes(spark.createDataFrame([(k if k else None, t) for k, t in enumerate(texts)], "doc_id long, text string").drop("score"))
    docs = docs.unionByName(docs.filter("doc_id = 2"))
    labels = spark.createDataFrame([(2, 1), (2, 1), (3, 0), (3, None), (None, 0), (99, 1)], "doc_id long, quality int")
    keep = ("doc_id", "score", "text")
    got = quality_model.score(docs, labels, F.lit(True), keep=keep)
    assert got.columns == [*keep, "score_", "predicted"]
    rows = got.collect()
    assert len(rows) == 7 and all(0 <= r["score_"] <= 1 for r in rows)
    by_text = {r["text"]: r["score_"] for r in rows}
    assert by_text["plain words here"] > by_text["SHOUT!! SHOUT!!"] and by_text[None] == by_text[""]
    none = quality_model.score(docs, labels.limit(0), F.lit(True)).collect()
    assert len(none) == 7 and {r["score"] for r in none} == {0.5}
    assert quality_model.score(docs.limit(0), labels, F.lit(True)).count() == 0


def test_temperature_makes_scores_honest():
    """With noisy targets a network that is too sure is cooled: mean score is near the share of ones among sure rows."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-1.2 * x[:, 0]))).astype(float)
    model = quality_model.Network(x[:600], y[:600])
    p = model.score(x[600:])
    sure = p > 0.8
    assert model.temperature > 1 and abs(p[sure].mean() - y[600:][sure].mean()) < 0.12
