import numpy as np
from pyspark.sql import functions as F

from folium.llm import nearest
from folium.llm.queries import op8_nearest

SMALL = "/root/testdata/sf0.001"


def brute(ids, x, q, k):
    far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != q][:k]
    return [(int(ids[i]), far[i]) for i in order]


def test_recall_on_the_whole_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").toPandas()
    ids, x = frame.vec_id.to_numpy(), np.stack(frame.embedding.to_numpy()).astype(float)
    rows = op8_nearest(spark, SMALL).collect()
    hit = 0
    for q in ids[ids % 100 == 0]:
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        want = brute(ids, x, q, 10)
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((x[ids == i][0] - x[ids == q][0]) ** 2).sum())) < 1e-12 for _, i, s in got)
        hit += len({i for _, i, _ in got} & {i for i, _ in want})
    assert hit >= 0.9 * len(rows)


def test_exact_with_all_lists_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(nearest, "GROUP_ROWS", 50)
    monkeypatch.setattr(nearest, "GROUP_QUERIES", 2)
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (400, 5)).astype(float)
    x[(x == 0).all(1)] = 1
    x[100:200] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame([*rows, rows[7], rows[7]], "vec_id long, embedding array<float>")
    got = nearest.search(frame, F.col("vec_id") % 50 == 0, lists=6, probed=6)
    ids = np.arange(400)
    for q in range(0, 400, 50):
        mine = [(r["vec_id"], r["score"]) for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()]
        assert [(i, round(s, 9)) for i, s in mine] == [(i, round(s, 9)) for i, s in brute(ids, x, q, 10)]


def test_unusable_vectors_and_small_tables(spark):
    schema = "vec_id long, embedding array<double>, list string"
    rows = [(0, [1.0, 0.0], "x"), (100, [0.0, 2.0], "x"), (1, None, "x"), (2, [0.0, 0.0], "x"), (3, [1.0, None], "x"), (4, [float("nan"), 1.0], "x"), (5, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (6, [1.0, 1.0, 1.0], "x"), (7, [], "x")]
    got = sorted(map(tuple, nearest.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0).collect()))
    assert [g[:3] for g in got] == [(0, 1, 100), (100, 1, 0)] and abs(got[0][3] - 5**0.5) < 1e-12
    assert nearest.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    assert nearest.search(spark.createDataFrame(rows[:1], schema), F.lit(True)).count() == 0
