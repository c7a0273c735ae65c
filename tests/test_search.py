"""Search syntax, places and excerpts against plain versions; the index in generations against one built anew."""

import random

import pytest
from pyspark.sql import functions as F

from folium.operators import search
from folium.operators.search import All, Any, Near, Phrase, Without
from folium.sources.postings import Index
from folium.streaming import maintenance

A, B, C, D = (Phrase((x,)) for x in "abcd")


@pytest.mark.parametrize(
    "text, tree",
    [
        ("", None), ("  ", None), ("¡!", None), ("a", A), ("á B", All((A, B))), ("a-b", Phrase(("a", "b"))), ('"a  b" c', All((Phrase(("a", "b")), C))), ("a OR b AND c", Any((A, All((B, C))))), ("(a OR b) AND c", All((Any((A, B)), C))),
        ("a OR b c", Any((A, All((B, C))))), ("a NOT b NOT c", Without(Without(A, B), C)), ("a AND b NOT c", All((A, Without(B, C)))), ("a NOT (b OR c)", Without(A, Any((B, C)))), ("a b NOT c d", Without(All((A, B)), All((C, D)))),
        ("NEAR(a b)", Near((A, B), 10)), ('x OR NEAR("a b" c, 3)', Any((Phrase(("x",)), Near((Phrase(("a", "b")), C), 3)))), ("(a) OR b", Any((A, B))), ("NEAR(a) AND b", All((A, B))), ("( a b )", All((A, B))), ('"" OR a', A), ("not or and", All(tuple(Phrase((w,)) for w in ("not", "or", "and")))),
    ],
)
def test_syntax(text, tree):
    assert search.parse(text) == tree


@pytest.mark.parametrize("text", ['"a', "(a OR b", "a AND  OR b", " AND a AND ", "a) OR b", "NEAR(a b, x)", "NEAR(a b", "a NOT ", "(a OR b) c)"])
def test_wrong_syntax(text):
    with pytest.raises(ValueError):
        search.parse(text + (" OR z" if text == '"a' else ""))


def starts(p, words):
    return [i for i in range(len(words)) if tuple(words[i : i + len(p.words)]) == p.words]


def plain(query, words):
    if isinstance(query, Phrase):
        return bool(starts(query, words))
    if isinstance(query, All):
        return all(plain(x, words) for x in query.parts)
    if isinstance(query, Any):
        return any(plain(x, words) for x in query.parts)
    if isinstance(query, Without):
        return plain(query.wanted, words) and not plain(query.unwanted, words)
    return any(all(any(s <= t <= s + len(p.words) + query.within for t in starts(o, words)) for o in query.phrases if o != p) for p in query.phrases for s in starts(p, words))


def texts(n=120):
    rng = random.Random(5)
    return [(k, " ".join(rng.choices("abcde", k=rng.randint(0, 14)))) for k in range(n)]


QUERIES = ["a", "a b c", '"a b" OR "c d e"', "a NOT b", "NEAR(a e, 1)", 'NEAR("a b" e d, 2)', '(NEAR(a b, 0) OR "d d") AND (c NOT "e e")', 'd NOT (NEAR(a c, 1) OR "b b" OR z)', "zz", "NEAR(a a, 1) OR zz"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    index = Index(spark, f"file://{tmp_path_factory.mktemp('index')}", block=4)
    index.apply(spark.createDataFrame(texts(), "key long, text string"))
    return index


@pytest.mark.parametrize("text", QUERIES)
def test_hits_and_ranks(spark, index, text):
    query = search.parse(text)
    frame = spark.createDataFrame(texts(), "key long, text string")
    want = sorted(k for k, t in texts() if plain(query, t.split()))
    whole = search.index(frame, "key")
    assert sorted(r["key"] for r in search.hits(whole, query, "key").collect()) == want
    assert sorted(r["key"] for r in index.hits(query).collect()) == want
    for limit in (3, 500):
        ranked = [(r["key"], round(r["rank"], 9)) for r in search.bm25(whole, query, limit, "key").collect()]
        assert [(r["key"], round(r["rank"], 9)) for r in index.top(query, limit).collect()] == ranked and len(ranked) == min(limit, len(want))


def test_top_leaves_blocks_out(spark, tmp_path, monkeypatch):
    """Two of many blocks hold the word often: the bound of the others is below the last match."""
    from folium.sources import postings

    monkeypatch.setattr(postings, "FIRST_BLOCKS", 2)
    index = Index(spark, f"file://{tmp_path}", block=5)
    rows = [(k, ("w " * 9 if k < 4 else "w ") + f"other words number {k} stand here") for k in range(200)]
    index.apply(spark.createDataFrame(rows, "key long, text string"))
    seen = []
    read = Index.tokens
    monkeypatch.setattr(Index, "tokens", lambda self, words, blocks=None: (seen.append(blocks.count()), read(self, words, blocks))[1])
    got = index.top(search.parse("w"), 2).collect()
    assert {r["key"] for r in got} <= {0, 1, 2, 3} and len(got) == 2
    assert seen[0] == 2 and seen[1] < 40


def test_generations_equal_a_new_index(spark, tmp_path):
    """New, changed, deleted and returning texts, before and after a merge, and a call that runs again."""
    index, now = Index(spark, f"file://{tmp_path}", block=4), {}
    assert index.hits(search.parse("a")).count() == 0 and index.top(search.parse("a")).count() == 0 and index.merge() is None
    rng = random.Random(2)
    for step in range(4):
        changes = [(rng.randrange(40), None if rng.random() < 0.3 else " ".join(rng.choices("abcde", k=rng.randint(0, 9)))) for _ in range(25)]
        changes = list({k: (k, t) for k, t in changes}.values())
        frame = spark.createDataFrame(changes, "key long, text string")
        assert index.apply(frame, step) == step and index.apply(frame.limit(0), step) == step
        now |= dict(changes)
        if step == 2:
            assert index.merge() == 3 and index.generations() == [3]
            index.apply(spark.createDataFrame([(1000 + step, "a b")], "key long, text string"))
            now[1000 + step] = "a b"
            break
        live = {k: t for k, t in now.items() if t}
        query = search.parse("a OR \"b c\"")
        whole = search.index(spark.createDataFrame(list(live.items()), "key long, text string"), "key")
        assert [tuple(r) for r in index.top(query, 9).collect()] == [tuple(r) for r in search.bm25(whole, query, 9, "key").collect()]
    live = {k: t for k, t in now.items() if t}
    assert sorted(r["key"] for r in index.texts().collect()) == sorted(live)
    got = sorted((r["key"], r["pos"], r["token"]) for r in index.tokens(list("abcde")).collect())
    assert got == sorted((k, i, w) for k, t in live.items() for i, w in enumerate(t.split()))


def test_index_follows_a_stream(spark, tmp_path):
    source, index = tmp_path / "texts", Index(spark, f"file://{tmp_path}/index")
    batches = [[(1, "La guerra"), (2, "la paz")], [(1, "otra cosa"), (3, "guerra")], [(2, None)]]
    for rows in batches:
        spark.createDataFrame(rows, "key long, text string").coalesce(1).write.mode("append").parquet(f"file://{source}")
        for _ in range(2):
            stream = spark.readStream.schema("key long, text string").parquet(f"file://{source}")
            maintenance.keep_index(stream, index, f"file://{tmp_path}/c", merge_beyond=2).awaitTermination(120)
    assert sorted(r["key"] for r in index.texts().collect()) == [1, 3]
    assert [r["key"] for r in index.hits(search.parse("guerra")).collect()] == [3] and index.hits(search.parse("la")).count() == 0
    assert len(index.generations()) <= 2


def plain_excerpt(text, words, size):
    parts = text.split()
    found = [(i, w) for i, p in enumerate(parts) for w in words if w in p.lower().replace(",", " ").split()]
    best = max(found, key=lambda h: (len({w for i, w in found if h[0] <= i < h[0] + size}), -h[0]))[0]
    last = max(min(i for i, w in found if w == x and i >= best) for x in {w for i, w in found if best <= i < best + size})
    begin = max(0, best - -(-(size - (last - best + 1)) // 2))
    shown = [f"<mark>{p}</mark>" if any(i == begin + k for i, _ in found) else p for k, p in enumerate(parts[begin : begin + size])]
    return "…" * (begin > 0) + " ".join(shown) + "…" * (len(parts) > begin + size)


@pytest.mark.parametrize("size", [1, 4, 16])
def test_excerpts(spark, size):
    rng = random.Random(size)
    rows = [" ".join(rng.choices(["a", "B,", "c", "x", "y", "z", "w,a", "v"], k=rng.randint(1, 60))) for _ in range(80)]
    rows = [r for r in rows if set(r.lower().replace(",", " ").split()) & set("abc")]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", search.excerpt(F.col("t"), search.parse("a OR b OR c NOT q"), size)).collect()
    assert [r[1] for r in got] == [plain_excerpt(r[0], "abc", size) for r in got]


def test_postings_are_made_where_texts_are(spark, tmp_path):
    """Texts are dealt out by block, once; neither their tokens nor a merge's places are shuffled row by row."""
    rows = spark.createDataFrame([("b a  b", ["a", "b"], [[1], [0, 2]]), ("", [], []), ("x", ["x"], [[0]])], "t string, words array<string>, ats array<array<int>>")
    for r in rows.withColumn("got", search.token_places(F.col("t"))).collect():
        assert [(g["token"], g["at"]) for g in r["got"]] == list(zip(r["words"], r["ats"], strict=True))
    plans, real = [], Index._write
    index = Index(spark, f"file://{tmp_path}", block=4)
    index._write = lambda rows, g: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), real(index, rows, g))
    index.apply(spark.createDataFrame([(k, "a b c a") for k in range(30)], "key long, text string"))
    index.apply(spark.createDataFrame([(k, "b b") for k in range(5)], "key long, text string"))
    index.merge()
    assert len(plans) == 3 and not any("hashpartitioning(token" in p or "posexplode" in p for p in plans)
    got = sorted((r["key"], r["token"], r["pos"]) for r in index.tokens(["a", "b", "c"]).collect())
    assert got == sorted((k, w, i) for k in range(30) for i, w in enumerate("b b".split() if k < 5 else "a b c a".split()))
