"""Approximate nearest neighbours: inverted lists scanned with an adaptive number of dimensions.

Vectors are dealt to lists by their nearest centre. In a list they lie rotated at random, in blocks of columns:
after each block a hypothesis test on the partial distance abandons the candidates that can hardly be nearer
than the nearest ones so far, and the last survivors are measured exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folium.llm.scratch import Scratch

#: Vectors that the centres are fitted on at most, and queries that set the number of probed lists.
SAMPLE, TRIALS = 20_000, 300
#: Share of true neighbours that the probed lists are to hold in the sample.
AIM = 0.98
#: Columns a block, rows a scan, and how many standard errors a partial distance must exceed.
BLOCK, ROWS, EPSILON = 16, 1024, 2.1
#: Rows and queries that meet in one group at most, about.
GROUP_ROWS, GROUP_QUERIES = 8192, 2048


def usable(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite numbers, not all zero, of the commonest length."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("v") == (length["d"] if length else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), kind).reshape(len(column), -1)


def centres(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Centres of a sample by Lloyd's rounds; the first ones are drawn from it."""
    rng = np.random.default_rng(8)
    found = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centres(sample, found, 1)[:, 0]
        counts = np.bincount(near, minlength=lists)
        sums = np.zeros_like(found)
        np.add.at(sums, near, sample)
        full = counts > 0
        found[full] = sums[full] / counts[full, None]
    return found


def nearest_centres(vectors: np.ndarray, found: np.ndarray, count: int) -> np.ndarray:
    """The numbers of each vector's nearest centres, nearest first."""
    out = np.empty((len(vectors), count), np.int64)
    for at in range(0, len(vectors), 4096):
        far = (found**2).sum(1) - 2 * vectors[at : at + 4096] @ found.T
        part = np.argpartition(far, count - 1, axis=1)[:, :count] if count < len(found) else np.tile(np.arange(len(found)), (len(far), 1))
        out[at : at + 4096] = np.take_along_axis(part, np.argsort(np.take_along_axis(far, part, 1), axis=1, kind="stable"), 1)
    return out


def probes(sample: np.ndarray, found: np.ndarray, k: int, aim: float) -> int:
    """How many lists hold the share `aim` of the true neighbours, on a few queries from the sample."""
    queries = sample[:: max(1, len(sample) // TRIALS)]
    lists = nearest_centres(sample, found, 1)[:, 0]
    order = nearest_centres(queries, found, len(found))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(found))[None, :].repeat(len(order), 0), 1)
    need = []
    for q, ranks in zip(queries, rank, strict=True):
        far = ((sample - q) ** 2).sum(1)
        need.append(ranks[lists[np.argsort(far, kind="stable")[1 : k + 1]]])
    need = np.sort(np.concatenate(need))
    return int(need[max(0, int(np.ceil(aim * len(need))) - 1)]) + 1 if len(need) else 1


def rotation(d: int) -> np.ndarray:
    """A random rotation of d dimensions, the same one each time."""
    q, r = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def scan(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its k nearest rows, itself left out: query id, row id and exact distance."""
    d = rows.shape[1]
    turn = rotation(d)
    cuts = list(range(0, d, BLOCK))
    turned, turned_queries = rows @ turn, queries @ turn
    columns = [np.ascontiguousarray(turned[:, a : a + BLOCK]) for a in cuts]
    # a partial distance over a of d turned dimensions, as a share of the whole, errs by about 1 / sqrt(a)
    slack = [min(a + BLOCK, d) / d * (1 + EPSILON / np.sqrt(min(a + BLOCK, d))) ** 2 for a in cuts]
    slack[-1] = 1 + 1e-9
    out = ([], [], [])
    for q_id, q, t in zip(query_ids.tolist(), queries, turned_queries, strict=True):
        best_id, best = np.empty(0, np.int64), np.empty(0)
        limit = np.inf
        for at in range(0, len(rows), ROWS):
            alive = np.arange(at, min(at + ROWS, len(rows)))
            far = np.zeros(len(alive))
            for a, block, share in zip(cuts, columns, slack, strict=True):
                far += ((block[alive] - t[a : a + BLOCK]) ** 2).sum(1)
                if np.isfinite(limit):
                    stay = far <= limit * share + 1e-12
                    alive, far = alive[stay], far[stay]
                    if not len(alive):
                        break
            alive = alive[ids[alive] != q_id]
            if len(alive):
                exact = np.sqrt(((rows[alive] - q) ** 2).sum(1))
                best_id, best = np.concatenate([best_id, ids[alive]]), np.concatenate([best, exact])
                order = np.lexsort((best_id, best))
                _, first = np.unique(best_id[order], return_index=True)
                order = order[np.sort(first)[:k]]
                best_id, best = best_id[order], best[order]
                if len(best) == k:
                    limit = best[-1] ** 2
        out[0].append(np.full(len(best), q_id, np.int64))
        out[1].append(best_id)
        out[2].append(best)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (np.int64, np.int64, np.float64), strict=True))


def _assign(shared, k: int):
    """Rows with their list. Of equal vectors in a batch only those with the smallest ids can come among the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1))
            order = np.argsort(ids, kind="stable")
            _, same = np.unique(v[order], axis=0, return_inverse=True)
            same = same.reshape(-1)
            by = np.lexsort((np.arange(len(same)), same))
            start = np.flatnonzero(np.diff(same[by], prepend=-1))
            rank = np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))
            fresh = np.ones(len(by), bool)
            fresh[1:] = (same[by][1:] != same[by][:-1]) | (ids[order][by][1:] != ids[order][by][:-1])
            if fresh.all():
                keep = np.sort(order[by[rank <= k]])
            else:  # repeated rows count once
                counts = np.cumsum(fresh)
                counts -= np.repeat(counts[start], np.diff(np.append(start, len(by))))
                keep = np.sort(order[by[fresh & (counts <= k)]])
            keep = pa.array(keep)
            lists = nearest_centres(v[keep.to_numpy()], shared.value, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(lists, pa.int32())], ["vec_id", "v", "list"])

    return run


def _probe(shared, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = nearest_centres(_matrix(batch.column(1)), shared.value, count).astype(np.int32)
                nested = pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * count, pa.int32()), pa.array(lists.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nested], ["vec_id", "v", "lists"])

    return run


def _meet(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        else:
            found = scan(rows["vec_id"].to_numpy(), _matrix(rows["v"]), queries["vec_id"].to_numpy(), _matrix(queries["v"]), k)
        return pa.table(dict(zip(names, map(pa.array, found), strict=True)))

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", vec_id: str = "vec_id", aim: float = AIM, lists: int | None = None, probed: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row where is_query (on vec_id) holds, the k nearest other rows found.

    score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id, and
    rows with equal ids count once. Null ids, and vectors that are null, zero, of another length than most or that
    hold null or other than finite numbers, take no part. With k other rows or fewer, all that were found come.
    The centres and the number of probed lists are fitted on a sample of SAMPLE vectors; every row is indexed.
    """
    spark = vectors.sparkSession
    own = Scratch(spark)
    rows = usable(vectors, vector, vec_id)
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    share = min(1.0, SAMPLE / total)
    drawn = rows.filter((F.xxhash64("vec_id", F.lit(8)) / F.lit(2.0**64) + 0.5) < share) if share < 1 else rows
    drawn = drawn.orderBy(F.xxhash64("vec_id", F.lit(8)), "vec_id").limit(SAMPLE).select("v").toArrow()
    sample = _matrix(drawn["v"])
    lists = min(lists or max(1, round(total**0.5 / 2)), 1024, max(1, len(sample) // 8))
    found = centres(sample, lists)
    probed = min(lists, probed or probes(sample, found, k, aim))
    shared = spark.sparkContext.broadcast(found)
    kind = rows.schema["v"].dataType.simpleString()
    indexed = own.keep(rows.mapInArrow(_assign(shared, k), f"vec_id long, v {kind}, list int"))
    asked = own.keep(rows.filter(is_query).dropDuplicates(["vec_id"]).mapInArrow(_probe(shared, probed), f"vec_id long, v {kind}, lists array<int>").withColumn("list", F.explode("lists")).drop("lists"))
    # large lists, and lists with many queries, are dealt to several groups; there is a row for each list
    sizes = indexed.groupBy("list").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("blocks"))
    sizes = sizes.join(asked.groupBy("list").agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("shares")), "list")
    sizes = F.broadcast(own.keep(sizes))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = indexed.join(sizes, "list").withColumn("block", deal("blocks")).withColumn("part", every("shares")).select("list", "block", "part", "vec_id", "v")
    right = asked.join(sizes, "list").withColumn("part", deal("shares")).withColumn("block", every("blocks")).select("list", "block", "part", "vec_id", "v")
    keys = ["list", "block", "part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meet(k), "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
