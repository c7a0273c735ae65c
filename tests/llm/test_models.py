import math
from collections import Counter
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from brute import words
from pyspark.sql import functions as F

from folium.llm import attention, bpe, language_id, lm_scoring, subwords
from folium.llm.queries import op6_language_id, word_vocabulary
from folium.llm.shingles import word_spans
from folium.llm.tasks import slices
from folium.llm.windows import hash_between, prefix_hashes

SMALL = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")
ODD = ["", " ", "It's WE'LL don't", "ΑΣ σς", "ﬁ Å e\u0301 İ", "a<|endoftext|>b <|startoftext|>", "x\u00a0y\u2003z\u0085", "日本語 テスト", "🧭🙂 ok", "12345 ²½", "<|", "\x00\x1c", "ab" * 3000, "word " * 3000]


def test_bpe_is_the_librarys(spark):
    known = tokenizers.Tokenizer.from_file(word_vocabulary())
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = [*ODD, *(r["text"] for r in rows), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = bpe.encode(docs, word_vocabulary()).orderBy("doc_id").collect()
    for r, text in zip(got, texts, strict=True):
        ids = known.encode(text or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == known.decode(ids, skip_special_tokens=False), repr(text)
    digest = bpe.digests(bpe.encode(docs.limit(0), word_vocabulary()))
    assert digest.count() == 0 and digest.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_language_held_out_accuracy(spark):
    rows = op6_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 200 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "hallo welt"), (None, "bon jour le monde"), (4, "hallo welt")], "doc_id long, text string")
    none = language_id.identify(docs, language_id.dictionaries(docs.withColumn("lang", F.lit(None).cast("string")))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    samples = {"de": b"hallo welt das ist eine probe", "fr": b"bon jour le monde"}
    got = [(r["doc_id"], r["lang_pred"], r["accepted"]) for r in language_id.identify(docs, samples).collect()]
    assert got == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "de", True), (None, "fr", True), (4, "de", True)]
    assert language_id.identify(docs.limit(0), samples).count() == 0
    tie = language_id.Compressors({"a": b"same words", "b": b"same words"}).judge("same words")
    assert tie == ("a", 0.0)


def test_language_margin_at_every_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judge = language_id.Compressors(language_id.dictionaries(docs.select("text", "lang"))).judge
    for lang in ("en", "fr"):
        texts = "\n".join(r["text"] for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").select("text").collect() if r["text"])
        whole = texts * (1 + 5_000_000 // len(texts))
        short, long = judge(whole[:50_000]), judge(whole[:5_000_000])
        assert short[0] == long[0] == lang
        assert long[1] > language_id.MIN_MARGIN and long[1] > short[1] / 2


def test_dictionaries_count_different_texts(spark):
    copies = spark.range(200_000).select(F.lit("the very same english text again and again and again").alias("text"), F.lit("en").alias("lang"))
    others = [(f"different english text with the number word {'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}", "en") for k in range(50)]
    short = [("kurz", "de"), ("und gut", "de"), ("12 345", "de"), ("so", None)]
    got = language_id.dictionaries(copies.unionByName(spark.createDataFrame([*others, *short], "text string, lang string")))
    assert sorted(got) == ["de", "en"] and set(got["de"].decode().split()) == {"kurz", "und", "gut"}
    assert got["en"].count(b"different english") == 50 and got["en"].count(b"the very same") == 1


def test_windows_score_each_place_once():
    lengths = np.array([0, 1, 2, attention.WINDOW, attention.WINDOW + 1, attention.WINDOW + 2, 200, 3])
    places, exists, counts = attention.window_places(lengths)
    scored = np.bincount(places[counts], minlength=lengths.sum())
    first = np.cumsum(lengths) - lengths
    want = np.ones(lengths.sum(), int)
    want[(first + lengths - 1)[lengths > 0]] = 0
    assert (scored == want).all() and (exists | ~counts).all()


def test_attention_gradients_and_scores():
    rng = np.random.default_rng(1)
    streams = [np.concatenate([[9], rng.integers(0, 9, n), [9]]) for n in (3, 40, 80)]
    model = attention.train(streams, 10, epochs=1)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    ids = rng.integers(0, 10, (2, attention.WINDOW))
    target = rng.integers(0, 10, ids.size)
    hidden = lambda: attention.forward(w, ids)[0].reshape(ids.size, -1)
    loss = lambda: -attention.choose(w, model.groups, hidden(), target)[0].sum()
    _, kept = attention.forward(w, ids)
    _, dr, grads = attention.choose(w, model.groups, hidden(), target, 1.0)
    grads |= attention.backward(w, kept, dr.reshape(*ids.shape, -1))
    assert sorted(grads) == sorted(w)
    for name, g in grads.items():
        place = tuple(rng.integers(0, n) for n in w[name].shape)
        if name == "embed":
            place = (ids[0, 3], 2)
        w[name][place] += 1e-5
        up = loss()
        w[name][place] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[place]) < 1e-3, name
        w[name][place] += 1e-5
    whole, lengths = np.concatenate(streams), np.array([len(s) for s in streams])
    places, _, counts = attention.window_places(lengths)
    want = np.zeros(len(whole))
    nxt = places[counts] + 1
    want[nxt] = all_logs(model, attention.forward(model.weights, whole[places])[0][counts])[np.arange(len(nxt)), whole[nxt]]
    assert np.abs(want - attention.score(model, whole, lengths)).max() < 1e-4
    # what follows a place has no part in its score
    other = whole.copy()
    other[30:] = 1
    assert np.allclose(attention.score(model, other, lengths)[:30], attention.score(model, whole, lengths)[:30], atol=1e-5)


def all_logs(model: attention.Model, r: np.ndarray) -> np.ndarray:
    """The logs of all subwords' probabilities after each hidden layer, in a plain way."""
    w, groups = model.weights, model.groups
    log_softmax = lambda z: z - np.log(np.exp(z.astype(np.float64)).sum(1, keepdims=True))
    first, out = log_softmax(r @ w["out"] + w["prior"]), np.empty((len(r), len(groups.of)))
    for k in range(len(groups.edges) - 1):
        members = np.flatnonzero(groups.of == k)
        at = groups.place[members]
        out[:, members] = first[:, [k]] + log_softmax(r @ w["member"][:, at] + w["usual"][at])
    return out


def test_groups_hold_each_subword_once_and_share_all_probability():
    stream = np.arange(300) % 150
    groups = attention.subword_groups(stream, 200, attention.GROUPS)
    assert sorted(groups.place) == list(range(200)) and groups.edges[-1] == 200 and (np.diff(groups.edges) > 0).all()
    assert ((groups.edges[groups.of] <= groups.place) & (groups.place < groups.edges[groups.of + 1])).all()
    model = attention.train([stream], 200, epochs=1)
    r = attention.forward(model.weights, stream[:48].reshape(2, 24))[0].reshape(48, -1)
    assert np.allclose(np.exp(all_logs(model, r)).sum(1), 1, atol=1e-4)


@pytest.mark.parametrize("common", [1, 50, 1 << 19])
def test_scores(spark, common, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PIECES", 300)
    monkeypatch.setattr(attention, "EPOCHS", 1)
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [(r["doc_id"], r["text"]) for r in rows] + [(900, None), (901, ""), (None, "The the"), (902, "zzz " * 50), (902, "zzz " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1))
    got = lm_scoring.score(docs, language_id.fold(F.col("doc_id"), 5) == 1, word_vocabulary(), common=common).collect()
    held = lambda i: i is not None and crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for i, t in rows if not held(i) for w in [*words(t), "\n"])
    n = sum(counts.values())
    base = lambda t: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in [*words(t), "\n"])
    want = sorted((repr(i), held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), "\n"]), n, round(base(t), 6)) for i, t in rows)
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_scores_against_a_plain_mixture_and_the_base(spark, monkeypatch):
    """score is the sum of mixed log10 probabilities, and on held-out texts the attention model alone beats the base."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect() if r["text"]]
    tuned, fitted = lm_scoring.tuned, {}
    monkeypatch.setattr(lm_scoring, "tuned", lambda model, pieces, *more: fitted.setdefault("model", (tuned(model, pieces, *more), pieces))[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, language_id.fold(F.col("doc_id"), 5) == 1, word_vocabulary()).collect()}
    model, pieces = fitted["model"]
    held = [(i, t) for i, t in rows if crc32(str(i).encode()) % 5 == 1]
    counts = Counter(w for i, t in rows if crc32(str(i).encode()) % 5 != 1 for w in [*words(t), "\n"])
    divisor = sum(counts.values()) + 0.5 * (len(counts) + 1)
    alone = base = 0
    for i, t in held:
        ws = words(t)
        data = np.frombuffer(" ".join(ws).encode(), np.uint8)
        starts, ends, first = word_spans(data, np.array([0, len(data)]))
        ids, n = subwords.cut(pieces, data, starts, ends)
        stream, lengths = lm_scoring._streams(pieces, ids, n, first)
        places, _, count = attention.window_places(lengths)
        logs = np.zeros(len(stream))
        nxt = places[count] + 1
        logs[nxt] = all_logs(model, attention.forward(model.weights, stream[places])[0][count])[np.arange(len(nxt)), stream[nxt]]
        per = [x.sum() for x in np.split(logs[1:-1], np.cumsum(n)[:-1])] + [logs[-1]]
        share = [(counts[w] + 0.5) / divisor for w in [*ws, "\n"]]
        want = sum(math.log10(0.5 * s + 0.5 * math.exp(p)) for s, p in zip(share, per, strict=True))
        assert abs(got[i]["score"] - want) < 1e-3 * len(share)
        alone += sum(per) / math.log(10)
        base += got[i]["base_score"]
    print("held-out log10:", alone, base, sum(got[i]["score"] for i, _ in held))
    assert alone > base and sum(got[i]["score"] for i, _ in held) > base


def test_every_training_text_teaches(spark, monkeypatch):
    """However few blocks the first weights come from, one more text or one more copy changes the model; pieces are those that all words use."""
    for name, value in (("PIECES", 60), ("START_WORDS", 1), ("PART_BLOCKS", 2), ("SUMS", 4)):
        monkeypatch.setattr(lm_scoring, name, value)
    monkeypatch.setattr(attention, "EPOCHS", 1)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 30 and length(text) < 2500").orderBy("doc_id").select("text").collect()][:14]
    tuned, fitted = lm_scoring.tuned, []
    monkeypatch.setattr(lm_scoring, "tuned", lambda model, pieces, *more: fitted.append((tuned(model, pieces, *more), pieces)) or fitted[-1][0])

    def weights(some):
        lm_scoring.score(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), F.lit(False), word_vocabulary())
        return attention.packed(fitted[-1][0].weights)

    base = weights(texts[:12])
    for more in (texts[12], texts[13], texts[3]):
        other = weights([*texts[:12], more])
        assert other.shape != base.shape or np.abs(other - base).max() > 1e-7
    ws = [w for t in texts[:12] for w in words(t)]
    data = np.frombuffer(" ".join(ws).encode(), np.uint8)
    want = subwords.chosen(word_vocabulary(), data, *word_spans(data, np.array([0, len(data)]))[:2], 60)
    assert np.array_equal(np.sort(fitted[0][1].hashes), np.sort(want.hashes))


def test_weighed_windows_learn_like_repeated_ones():
    rng = np.random.default_rng(3)
    stream = rng.integers(0, 9, 60)
    model = attention.train([stream], 10, epochs=1)
    places, exists, _ = attention.window_places(np.array([60]))
    one, many = (attention.Trainer(model.weights, model.groups) for _ in range(2))
    one.learn(stream, places, exists, 1e-3, np.array([3, 1, 2]))
    twice = [0, 0, 0, 1, 2, 2]
    many.learn(stream, places[twice], exists[twice], 1e-3)
    assert all(np.allclose(one.first[k], many.first[k], atol=1e-6) and one.first[k].any() for k in one.w)
    pairs = np.bincount(stream[:-1] * 10 + stream[1:], minlength=100).reshape(10, 10)
    assert (attention.pair_groups(np.bincount(stream, minlength=10), pairs, 3).of == attention.subword_groups(stream, 10, 3).of).all()


def test_scores_without_training_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm_scoring.score(docs, F.lit(True), word_vocabulary()).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert lm_scoring.score(docs.limit(0), F.lit(False), word_vocabulary()).count() == 0


def test_pieces_rebuild_words():
    data = np.frombuffer("the theory étude \U0001f600x 10".encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    pieces = subwords.chosen(word_vocabulary(), data, starts, ends, 50)
    ids, counts = subwords.cut(pieces, data, starts, ends)
    assert counts.sum() == len(ids) and (counts >= 1).all() and (ids < pieces.border).all() and counts[0] == 1


def test_languages_against_brute_force(spark):
    """Dictionaries and sizes made in a plain way, for all rows of the small table."""
    import re

    import zstandard

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text", F.lit(6)).alias("h")).collect()
    bare = lambda t: re.sub(r"[\W\d_]+", " ", t.lower())
    samples = {}
    for lang in sorted({r["lang"] for r in rows if r["lang"]}):
        texts = {(len(r["text"]) < 40, r["h"], r["text"][:1200]) for r in rows if r["lang"] == lang and r["text"] and any(map(str.isalpha, r["text"])) and crc32(str(r["doc_id"]).encode()) % 4 != 2}
        assert len(texts) <= 4 * 96
        samples[lang] = bare("\n".join(t for _, _, t in sorted(texts)[:96])).encode()
    ways = {k: zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False) for k, v in samples.items()}
    got = {r["doc_id"]: r for r in op6_language_id(spark, SMALL).collect()}
    assert len(got) == len(rows) == 200
    for r in rows:
        mine = got[r["doc_id"]]
        assert mine["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if not r["text"] or not any(map(str.isalpha, r["text"])):
            assert (mine["lang_pred"], mine["score"], mine["accepted"]) == ("und", 0.0, False)
            continue
        raw = bare(r["text"]).encode()
        sizes = sorted((sum(len(w.compress(raw[at : at + (1 << 14)])) for at in range(0, len(raw), 1 << 14)), k) for k, w in ways.items())
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert mine["lang_pred"] == sizes[0][1] and abs(mine["score"] - margin) < 1e-12 and mine["accepted"] == (margin >= 0.004)


def test_scores_do_not_depend_on_the_split(spark, monkeypatch):
    """The same table in one task and in seven, with repeated rows, several parts and two steps of sums."""
    for name, value in (("PIECES", 200), ("PART_BLOCKS", 3), ("SUMS", 4), ("TUNE_TEXTS", 1), ("TUNE_BLOCKS", 1), ("LOT", 2)):
        monkeypatch.setattr(lm_scoring, name, value)
    monkeypatch.setattr(attention, "EPOCHS", 1)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 60").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id < 5"))
    runs = [{(r["doc_id"], round(r["score"], 3)) for r in lm_scoring.score(d, language_id.fold(F.col("doc_id"), 5) == 1, word_vocabulary()).collect()} for d in (docs.coalesce(1), docs.repartition(7))]
    assert runs[0] == runs[1]


def test_words_are_cut_once_a_task(monkeypatch):
    """Texts whose words come again and again: the tasks that count, deal out blocks and score cut each word once, and train without cutting."""
    words_of = ["alpha", "beta", "gamma", "delta's", "épsilon"] * 700
    texts = [" ".join(words_of[k:] + words_of[:k]) for k in range(40)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 10])], ["text"]) for k in range(0, 40, 10)]
    monkeypatch.setattr(lm_scoring, "slices", lambda column: slices(column, 1 << 16))
    number, cut = [], subwords.cut
    monkeypatch.setattr(subwords, "cut", lambda pieces, data, starts, ends: number.append(len(starts)) or cut(pieces, data, starts, ends))
    shared = lambda value: SimpleNamespace(value=value)
    list(lm_scoring._count(shared(subwords.whole(word_vocabulary())))(iter(batches)))
    assert sum(number) == 5
    data = np.frombuffer(texts[0].encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    pieces = subwords.chosen(word_vocabulary(), data, starts, ends, 20)
    number.clear()
    blocks = pa.Table.from_batches(lm_scoring._draw(1, shared(pieces))(iter(batches)))["ids"]
    assert sum(number) == 5 and len(blocks) == 40 * -(-3500 // 64)
    stream, lengths = lm_scoring._stored_streams(blocks.combine_chunks())
    ids, _ = cut(pieces, data, starts, ends)
    assert np.array_equal(stream[: len(ids) + 2], [pieces.border, *ids, pieces.border]) and lengths.sum() == len(stream)
    number.clear()
    model = attention.train([stream[:200]], pieces.size + 1, epochs=1)
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 55), blocks.combine_chunks()[:55], pa.array([1] * 55)], ["part", "ids", "times"])
    assert [r.num_rows for r in lm_scoring._tune(shared(model))(iter([rows]))] == [1] and not number
    scorer = lm_scoring.Scorer(model, pieces, np.empty(0, np.uint64), np.empty(0, np.int64), 1, 10.0)
    assert sum(r.num_rows for r in lm_scoring._score(shared(scorer))(iter(batches))) == 40 and sum(number) == 5


@pytest.mark.parametrize(("slots", "pool"), [(4, 1 << 20), (1 << 10, 50), (1 << 20, 1 << 22)])
def test_remembered_cuts_are_the_same(slots, pool, monkeypatch):
    """However few words have a place, and however soon all are forgotten."""
    monkeypatch.setattr(subwords, "SLOTS", slots)
    monkeypatch.setattr(subwords, "POOL", pool)
    data = np.frombuffer(("the theory of étude \U0001f600x 10 theatre others then " + "ab" * 300).encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    pieces = subwords.chosen(word_vocabulary(), data, starts, ends, 12)
    hashes = hash_between(*prefix_hashes(data), starts, ends)
    rng, cutter = np.random.default_rng(2), subwords.Cutter(pieces)
    for _ in range(30):
        some = rng.permutation(len(starts))[: rng.integers(0, len(starts) + 1)]
        got, want = cutter.cut(data, starts[some], ends[some], hashes[some]), subwords.cut(pieces, data, starts[some], ends[some])
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("factor", [1, 60])
def test_steps_with_large_weights(factor):
    """Attention, probabilities and what they learn, where their exponentials would overflow too."""
    rng = np.random.default_rng(5)
    model = attention.train([rng.integers(0, 30, 400)], 31, epochs=1)
    w = {k: v.astype(np.float64) * (factor if k in ("q", "member") else 1) for k, v in model.weights.items()}
    ids, target = rng.integers(0, 31, (3, attention.WINDOW)), rng.integers(0, 31, 3 * attention.WINDOW)
    x = w["embed"][ids]
    a = (x @ w["q"]) @ (x @ w["k"]).transpose(0, 2, 1) / math.sqrt(attention.WIDTH) + w["bias"][attention._distance()]
    a = np.where(np.tri(attention.WINDOW, dtype=bool), a, -np.inf)
    a = np.exp(a - a.max(-1, keepdims=True))
    want = np.maximum(x @ w["own"] + a / a.sum(-1, keepdims=True) @ (x @ w["v"]) @ w["seen"] + w["base"], 0)
    got, _ = attention.forward(w, ids)
    assert np.allclose(got, want)
    r = got.reshape(len(target), -1)
    logs, dr, grads = attention.choose(w, model.groups, r, target, 1.0)
    assert np.allclose(logs, attention.choose(w, model.groups, r, target)[0]) and all(np.isfinite(g).all() for g in (dr, *grads.values()))
    step = 1e-6 * rng.standard_normal(r.shape)
    up, down = (attention.choose(w, model.groups, r + s, target)[0].sum() for s in (step, -step))
    assert abs((up - down) / 2 + (dr * step).sum()) < 1e-4 * np.abs(dr * step).sum() + 1e-9
