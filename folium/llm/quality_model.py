"""Quality of texts by a small network over random-indexing word vectors.

Every word has a fixed sparse random index vector; its word vector is the sum of those of the words around it and its
own, over the whole corpus. Words are dealt to a fixed number of buckets by a hash, which bounds the table of vectors
at BUCKETS * DIMS numbers whatever the vocabulary. A text is the mean and the spread of its words' vectors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import free_names
from folium.llm.scratch import Scratch
from folium.llm.shingles import lowered
from folium.llm.tasks import SLICE, frugal, slices
from folium.llm.windows import flat_bytes, hash_between, prefix_hashes

#: Buckets of words, numbers of a vector, and those of an index vector that are not zero.
BUCKETS, DIMS, NONZERO = 1 << 16, 32, 4
#: Words on either side that a word's vector is made of.
REACH = 2
#: Labelled texts that the network is fitted to at most, and the share of them that only sets the temperature.
SAMPLE, CALIBRATION = 20_000, 5
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 128, 0.01, 1e-4
#: A text is predicted good from this score on.
GOOD = 0.3
SEED = 12
#: Buckets whose sums travel in one row.
_BLOCK = 256

#: Bytes of one class in a row are a word: letters and bytes beyond ASCII, digits, or one symbol repeated; 0 parts words.
_CLASS = np.array([0 if b <= 32 or b == 127 else 1 if b >= 128 or chr(b).isalpha() else 2 if chr(b).isdigit() else b for b in range(256)], np.uint8)
#: The words put before each word of two capitals or more, which itself is lowered, and before each that comes twice running.
_SHOUT, _AGAIN = np.uint64(0x5348_4F55_54), np.uint64(0x4147_4149_4E)


def index_vectors() -> np.ndarray:
    """For each bucket NONZERO entries of 1 or -1 at random places; those at one place add up."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIMS), np.int32)
    for _ in range(NONZERO):
        np.add.at(out, (np.arange(BUCKETS), rng.integers(0, DIMS, BUCKETS)), rng.choice(np.array([-1, 1], np.int32), BUCKETS))
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word, and the number of the first word of each row (one more than rows)."""
    if not len(data):
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _CLASS[data]
    first = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    edges = np.append(np.flatnonzero(first), len(data))
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    total, inverse = prefix_hashes(lowered(data))
    h = hash_between(total, inverse, starts, ends)
    capitals = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 65) & (data <= 90), out=capitals[1:])
    shouted = (capitals[ends] - capitals[starts] == ends - starts) & (ends - starts > 1)
    rows = np.searchsorted(starts, offsets)
    again = np.zeros(len(h), bool)
    np.equal(h[1:], h[:-1], out=again[1:])
    again[rows[:-1][rows[:-1] < len(h)]] = False
    if shouted.any() or again.any():
        marks = np.concatenate([np.flatnonzero(shouted), np.flatnonzero(again)])
        h = np.insert(h, marks, np.repeat([_SHOUT, _AGAIN], [shouted.sum(), again.sum()]))
        rows = rows + np.concatenate([[0], np.cumsum(shouted.astype(np.int64) + again)])[rows]
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), rows


def pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of whole texts up to SLICE bytes; longer texts come in pieces cut at blanks.

    Words on two sides of a cut are not neighbours. Where a piece goes depends on its text alone.
    """
    for row, n in slices(texts):
        data, offsets = flat_bytes(texts.slice(row, n))
        if len(data) <= 2 * SLICE or n > 1:
            yield row, data, offsets
            continue
        at = 0
        while at < len(data):
            end = min(len(data), at + SLICE)
            while end < len(data):
                blank = np.flatnonzero(_CLASS[data[end : end + SLICE]] == 0)
                if len(blank):
                    end += int(blank[0])
                    break
                end = min(len(data), end + SLICE)
            yield row, data[at:end], np.array([0, end - at])
            at = end


def _neighbours(buckets: np.ndarray, rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each word the sum of the index vectors of its row's words within REACH, itself included."""
    own = index[buckets]
    out = own.copy()
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for k in range(1, REACH + 1):
        same = (row[k:] == row[:-k])[:, None]
        out[k:] += own[:-k] * same
        out[:-k] += own[k:] * same
    return out


def _sums(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((BUCKETS, DIMS + 1), np.int64)
        for batch in batches:
            for _, data, offsets in pieces(batch.column(at)):
                buckets, rows = words(data, offsets)
                if not len(buckets):
                    continue
                order = np.argsort(buckets, kind="stable")
                ordered = buckets[order]
                edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
                at_bucket = ordered[edges]
                total[at_bucket, :DIMS] += np.add.reduceat(_neighbours(buckets, rows, index)[order], edges, axis=0)
                total[at_bucket, DIMS] += np.diff(np.append(edges, len(ordered)))
        for block in range(0, BUCKETS, _BLOCK):
            found = np.flatnonzero(total[block : block + _BLOCK, DIMS])
            if len(found):
                body = zlib.compress(found.astype("<i8").tobytes() + total[block + found].astype("<i8").tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([len(found)], pa.int32()), pa.array([body], pa.binary())], ["block", "n", "body"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's blocks: a fixed number of them at most, however many rows come."""
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = np.frombuffer(zlib.decompress(body), "<i8")
            blocks.setdefault(block, np.zeros((_BLOCK, DIMS + 1), np.int64))[raw[:n]] += raw[n:].reshape(n, DIMS + 1)
    for block, sums in blocks.items():
        found = np.flatnonzero(sums[:, DIMS])
        yield pa.RecordBatch.from_arrays([pa.array(block + found, pa.int32()), pa.array(sums[found].tolist(), pa.list_(pa.int64()))], ["bucket", "sums"])


def word_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """Of each bucket that occurs, the sum of its words' surroundings and, last, their number; BUCKETS rows at most.

    Null and empty texts add nothing. A task hands on a row for each block of buckets, and blocks are summed as they arrive.
    """
    handed = docs.select(F.col(text).alias("text")).mapInArrow(frugal(_sums(0)), "block int, n int, body binary")
    return handed.repartition("block").mapInArrow(frugal(_merged), "bucket int, sums array<bigint>")


def word_vectors(sums: list[tuple[int, list[int]]]) -> np.ndarray:
    """Each bucket's mean surroundings without what is common to all words, of length 1; zeros where nothing was seen."""
    out = np.zeros((BUCKETS, DIMS))
    if sums:
        seen = np.array([b for b, _ in sums])
        found = np.array([s for _, s in sums], float)
        common = found[:, :DIMS].sum(axis=0) / found[:, DIMS].sum()
        mean = found[:, :DIMS] / found[:, DIMS:] - common
        out[seen] = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    return out.astype(np.float32)


def _pooled(vectors, at: int, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vectors.value
        for batch in batches:
            n = np.zeros(batch.num_rows)
            sums, squares = np.zeros((batch.num_rows, DIMS)), np.zeros((batch.num_rows, DIMS))
            for row, data, offsets in pieces(batch.column(at)):
                buckets, rows = words(data, offsets)
                some = np.flatnonzero(np.diff(rows))
                if not len(some):
                    continue
                found = table[buckets]
                n[row + some] += np.diff(rows)[some]
                sums[row + some] += np.add.reduceat(found, rows[some], axis=0, dtype=float)
                squares[row + some] += np.add.reduceat(found * found, rows[some], axis=0, dtype=float)
            count = np.maximum(n, 1)[:, None]
            mean = sums / count
            spread = np.sqrt(np.maximum(squares / count - mean * mean, 0))
            both = np.concatenate([mean, spread, np.log1p(n)[:, None]], axis=1).astype(np.float32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(both.reshape(-1)), both.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], lists], [*batch.schema.names[:kept], "pooled"])

    return run


class Network:
    """Two layers, tanh between them; what they give is divided by a temperature before it becomes a probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        """Fit to rows of numbers and targets from 0 to 1; the order of the rows decides which set the temperature."""
        self.middle, self.width = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        x = self._scaled(x)
        rng = np.random.default_rng(SEED)
        self.weights = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        apart = np.arange(len(x)) % CALIBRATION == CALIBRATION - 1
        self._train(x[~apart], y[~apart], rng)
        if apart.any():
            logits, target = self._logits(x[apart])[0], y[apart]
            tried = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
            losses = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in tried]
            self.temperature = float(tried[int(np.argmin(losses))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.width, -8, 8)

    def _logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.weights[0] + self.weights[1])
        return hidden @ self.weights[2] + self.weights[3], hidden

    def _train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        first, second, step = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], 0
        batches = max(1, len(x) // BATCH)
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            for rows in np.array_split(rng.permutation(len(x)), batches):
                logits, hidden = self._logits(x[rows])
                off = (1 / (1 + np.exp(-logits)) - y[rows]) / len(rows)
                back = np.outer(off, self.weights[2]) * (1 - hidden * hidden)
                slopes = [x[rows].T @ back + DECAY * self.weights[0], back.sum(axis=0), hidden.T @ off + DECAY * self.weights[2], off.sum(keepdims=True)]
                step += 1
                for w, g, m, v in zip(self.weights, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of 1 for each row."""
        return 1 / (1 + np.exp(-self._logits(self._scaled(x))[0] / self.temperature))


def _scores(network, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column(kept).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, 2 * DIMS + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(network.value.score(x.astype(float)))], [*batch.schema.names[:kept], "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, teaches: Column, text: str = "text", doc_id: str = "doc_id", label: str = "quality", keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """The columns `keep` of every row with score (the probability that its label is 1) and predicted (1 from GOOD on).

    `labels` has doc_id and a label of 0 or 1; `teaches` is a condition on its rows. The network learns from at most about
    `sample` ids that it holds for, drawn by their hash; of several labels of one id the mean is the target, null labels
    and ids teach nothing, and an id without a document neither. Word vectors are made of all whole texts, labelled
    or not; texts of any length are read whole. A null or empty text is scored too, as one without words. Repeated
    rows are scored like others. Without labels every score is 0.5; no rows give none. Of the new columns, those whose
    names are in `keep` get underscores; other columns play no part.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    names = free_names(keep, ("score", "predicted"))
    own = [F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]
    vectors = context.broadcast(word_vectors([(r["bucket"], r["sums"]) for r in word_sums(docs, text).collect()]))
    rows = docs.select(*own, F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep) + 1])
    pooled = Scratch(spark).keep(rows.mapInArrow(frugal(_pooled(vectors, len(keep) + 1, len(keep) + 1)), f"{kinds}, pooled array<float>"))

    taught = labels.filter(teaches).select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("y")).dropna().groupBy("id").agg(F.avg("y").alias("y"))
    taught = taught.withColumn("h", F.xxhash64("id", F.lit(SEED)))
    share = min(1.0, sample / max(1, taught.count()))
    taught = taught.filter((F.col("h") / F.lit(2.0**64) + 0.5) <= share)
    # of rows with one id and different texts one teaches
    learned = pooled.join(taught, "id").groupBy("h", "id").agg(F.min(F.struct("pooled", "y")).alias("row")).select("h", "id", "row.*").collect()
    learned.sort(key=lambda r: (r["h"], str(r["id"])))
    if not learned:
        found = pooled.select(*(f"c{k}" for k in range(len(keep))), F.lit(0.5).alias("score"))
    else:
        network = context.broadcast(Network(np.array([r["pooled"] for r in learned]), np.array([r["y"] for r in learned])))
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
        found = pooled.select(*(f"c{k}" for k in range(len(keep))), "pooled").mapInArrow(frugal(_scores(network, len(keep))), f"{kinds}, score double")
    return found.withColumn("predicted", (F.col("score") >= GOOD).cast("int")).toDF(*keep, *names)
