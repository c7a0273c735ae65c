import random

import numpy as np
import pytest
from brute import without_repeats as brute

from folium.llm import suffix_dedup
from folium.llm.windows import minimiser_runs

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def run(spark, texts, length, gram, wide=1500):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffix_dedup.without_repeats(docs, length=length, gram=gram, wide=wide).orderBy("doc_id").collect()
    return [tuple(r[c] for c in COLUMNS) for r in rows]


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcé ") for _ in range(rng.randint(10, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        texts.append("".join(rng.choice([*passages, "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 40)))]) for _ in range(rng.randint(0, 6))))
    return [*texts, texts[0], texts[3], None, "", "ab" * 300, "x" * 500]


@pytest.mark.parametrize("wide", [1500, 3])
def test_against_brute_force(spark, wide):
    texts = corpus(wide)
    assert run(spark, texts, 24, 8, wide) == brute(texts, 24)


def test_long_text_in_parts_and_repeats_within(spark, monkeypatch):
    rng = random.Random(1)
    block = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = [block + "".join(rng.choice("xyz") for _ in range(700_000)) + block, "short", "q" * 199, "q" * 200]
    assert run(spark, texts, 200, 32)[0][1:3] == (6000, 2)
    assert run(spark, texts, 200, 32)[3] == brute(texts[2:], 200)[1]


def test_empty_table_clashing_columns_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.without_repeats(empty).count() == 0
    row = (7, "abcdefgh" * 40, "kept?", 1, None)
    docs = spark.createDataFrame([row, row, (None, "fresh", "x", 2, "y")], "doc_id long, text string, cid string, n_bytes int, spans string")
    rows = suffix_dedup.without_repeats(docs, keep=("doc_id", "cid"), with_text=True).orderBy(suffix_dedup.F.col("doc_id").desc_nulls_last()).collect()
    assert [(r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_text"], r["cid"]) for r in rows] == [(7, 320, 320, "", "kept?")] * 2 + [(None, 5, 0, "fresh", "x")]


def test_order_of_suffixes():
    rng = random.Random(5)
    for _ in range(60):
        pieces = [bytes(rng.choice(b"aab\x00") for _ in range(rng.randint(6, 40))) for _ in range(rng.randint(1, 6))]
        windows = np.array([len(p) - 5 for p in pieces])
        order, data, starts = suffix_dedup.suffix_order(pieces, windows, 6)
        text = data.tobytes()
        got = [text[i : i + 6] for i in order]
        assert sorted(order.tolist()) == [s + i for s, n in zip(starts.tolist(), windows.tolist()) for i in range(n)]
        assert got == sorted(got)
        shared = suffix_dedup.common_prefixes(order, data, 6)
        for a, b, n in zip(got, got[1:], shared[1:].tolist()):
            assert n == next((k for k in range(6) if a[k] != b[k]), 6)


def test_equal_windows_share_a_minimiser():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[2000:2300] = data[100:400]
    offsets = np.array([0, 900, 900, 3000])
    start, n, value, many = minimiser_runs(data, offsets, 40, 8)
    of = {}
    for s, k, v in zip(start.tolist(), n.tolist(), value.tolist()):
        for i in range(s, s + k):
            of.setdefault(data[i : i + 40].tobytes(), set()).add(v)
    assert all(len(v) == 1 for v in of.values())
    assert n.sum() == 861 + 2061
