"""Language-model scores of whole texts: a self-attention model over subwords, mixed with corpus-wide word counts.

The attention model learns from every block of words of all training texts. Its pieces are those that their words use
most, and its groups and first shares follow from all pairs of neighbouring pieces. A bounded number of blocks, drawn by
hashes, brings the first weights near; then tasks go on from there with all blocks, dealt to parts by hash, in rounds,
after each of which the parts' weights are averaged. The counts are of all training
texts, and a word's probability is a fixed mixture of its share in the corpus and of what the attention model gives
its subwords. The commonest words' counts go to all tasks, a fixed number of them; every other word travels to its
count, so that no table of all words is held anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.llm import attention, subwords
from folium.llm.scratch import Scratch
from folium.llm.shingles import lowered, word_spans
from folium.llm.tasks import frugal, slices
from folium.llm.windows import flat_bytes, hash_between, prefix_hashes

#: Words, about, that the attention model's first weights come from; words of a block; pieces besides single bytes.
START_WORDS, BLOCK_WORDS, PIECES = 400_000, 64, 600
#: One in so many texts, and of their blocks, trains it: all of them.
TUNE_TEXTS, TUNE_BLOCKS = 1, 1
#: Blocks of a part, at least, which one model is trained on; those that it learns from at a time; parts at most, whose sums of weights are stored.
PART_BLOCKS, LOT, MOST_PARTS = 1024, 64, 4096
#: Rounds that parts are dealt to; each goes on from the averaged weights of the one before.
ROUNDS = 8
#: Partial sums of weights that one step adds up at most, the driver's included.
SUMS = 64
#: Words whose counts every task gets: 16 bytes each.
COMMON = 1 << 19
#: Weight of the corpus-wide share in a word's probability.
MIXTURE = 0.5


@dataclass
class Scorer:
    """What every task gets: the model, its pieces, the commonest words' hashes in order with counts, and the totals."""

    model: attention.Model | None
    pieces: subwords.Pieces | None
    hashes: np.ndarray
    counts: np.ndarray
    ends: int
    divisor: float


def _count(shared):
    """The different words of a batch with their numbers, and how often a task's words use each piece of the whole vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: subwords.Pieces = shared.value
        cutter, used = subwords.Cutter(full), np.zeros(full.size, np.int64)
        rows = lambda keys, counts, piece: pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), piece)), pa.array(keys.view(np.int64)), pa.array(counts)], ["piece", "word", "c"])
        for batch in batches:
            found, number = [], []
            for at, n in slices(batch.column(0)):
                data, offsets = flat_bytes(batch.column(0).slice(at, n))
                data = lowered(data)
                starts, ends, _ = word_spans(data, offsets)
                total, inverse = prefix_hashes(data)
                words, where, counts = np.unique(hash_between(total, inverse, starts, ends), return_index=True, return_counts=True)
                ids, each = cutter.cut(data, starts[where], ends[where], words)
                used += np.bincount(ids, np.repeat(counts, each), full.size).astype(np.int64)
                found.append(words)
                number.append(counts)
            if found:
                words, where = np.unique(np.concatenate(found), return_inverse=True)
                yield rows(words, np.bincount(where, np.concatenate(number), len(words)).astype(np.int64), False)
        pieces = np.flatnonzero(used)
        yield rows(pieces, used[pieces], True)

    return run


def _streams(pieces: subwords.Pieces, ids: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ids between two borders, laid end to end, and the lengths."""
    bounds = np.concatenate([[0], np.cumsum(counts)])[first]
    lengths = np.diff(bounds) + 2
    out = np.full(int(lengths.sum()), pieces.border)
    head = np.cumsum(lengths) - lengths
    inner = np.ones(len(out), bool)
    inner[head] = inner[head + lengths - 1] = False
    out[inner] = ids
    return out, lengths


def _blocks(texts: pa.Array, share: float, cutter: subwords.Cutter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of the drawn blocks of texts end to end, with the border where a text begins or ends, and their numbers."""
    for at, n in slices(texts):
        data, offsets = flat_bytes(texts.slice(at, n))
        data = lowered(data)
        starts, ends, first = word_spans(data, offsets)
        number = -(-np.diff(first) // BLOCK_WORDS)
        row = np.repeat(np.arange(n), number)
        place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        begin = first[row] + place * BLOCK_WORDS
        stop = np.minimum(begin + BLOCK_WORDS, first[row + 1])
        total, inverse = prefix_hashes(data)
        drawn = np.ones(len(begin), bool) if share >= 1 else hash_between(total, inverse, starts[begin], ends[stop - 1]) < np.uint64(int(share * 2**64))
        begin, stop, row, place = begin[drawn], stop[drawn], row[drawn], place[drawn]
        if len(begin):
            words = np.repeat(begin - np.cumsum(stop - begin) + (stop - begin), stop - begin) + np.arange((stop - begin).sum())
            ids, each = _cut_all(cutter, data, starts[words], ends[words], hash_between(total, inverse, starts[words], ends[words]))
            stream, lengths = _streams(cutter.pieces, ids, each, np.concatenate([[0], np.cumsum(stop - begin)]))
            head, tail = place > 0, stop < first[row + 1]
            inside, last = np.ones(len(stream), bool), np.cumsum(lengths) - 1
            inside[(last - lengths + 1)[head]] = inside[last[tail]] = False
            yield stream[inside], lengths - head - tail


def _cut_all(cutter: subwords.Cutter, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words one after another, and the number of each; a word that comes again is cut once."""
    kinds, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    ids, counts = cutter.cut(data, starts[where], ends[where], kinds)
    head, each = np.cumsum(counts) - counts, counts[inverse]
    return ids[np.arange(each.sum()) + np.repeat(head[inverse] - np.cumsum(each) + each, each)], each


def _draw(share: float, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = subwords.Cutter(shared.value)
        for batch in batches:
            for stream, lengths in _blocks(batch.column(0), share, cutter):
                offsets = np.concatenate([[0], np.cumsum(2 * lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(stream.astype(np.uint16))])], ["ids"])

    return run


def _stored_streams(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of blocks as a table holds them, two bytes each, end to end, and their numbers."""
    data, offsets = flat_bytes(ids)
    return data.view(np.uint16).astype(np.int64), np.diff(offsets) // 2


def _pairs(size: int):
    """How often pieces, below size, come one behind the other in the blocks of a task, as the first one's id times size plus the second's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * size, np.int64)
        for batch in batches:
            for at, rows in slices(batch.column(0)):
                stream, lengths = _stored_streams(batch.column(0).slice(at, rows))
                inside = np.ones(len(stream), bool)
                inside[np.cumsum(lengths) - 1] = False
                at_first = np.flatnonzero(inside)
                times = np.repeat(batch.column(1).slice(at, rows).to_numpy(), lengths)[at_first]
                pairs, where = np.unique(stream[at_first] * size + stream[at_first + 1], return_inverse=True)
                counts[pairs] += np.bincount(where, times, len(pairs)).astype(np.int64)
        pairs = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts[pairs])], ["pair", "c"])

    return run


def train(ids: pa.Array, pieces: subwords.Pieces, pairs: np.ndarray) -> attention.Model:
    """A model of blocks, with the groups and first shares of all pairs of neighbouring pieces."""
    stream, lengths = _stored_streams(ids)
    return attention.train(np.split(stream, np.cumsum(lengths)[:-1]), pieces.size + 1, pairs=pairs)


def _tune(shared):
    """One row a part: windows, and weights times windows. A part's blocks come one behind the other, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attention.one_thread()
        model: attention.Model = shared.value
        part, trainer, windows = None, None, 0

        def done() -> pa.RecordBatch:
            flat = windows * attention.packed(trainer.w)
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([windows]), pa.array([flat.tobytes()], pa.binary())], ["part", "windows", "sums"])

        # lots of blocks are the same however the rows come in batches
        waiting: list[tuple[int, bytes, int]] = []

        def learn() -> int:
            _, ids, times = zip(*waiting, strict=True)
            return attention.tune(trainer, [np.frombuffer(x, np.uint16).astype(np.int64) for x in ids], np.array(times))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != part or len(waiting) == LOT:
                    if waiting:
                        windows += learn()
                        waiting = []
                    if row[0] != part:
                        if windows:
                            yield done()
                        part, trainer, windows = row[0], attention.Trainer({k: v.copy() for k, v in model.weights.items()}, model.groups), 0
                waiting.append(row)
        if waiting:
            windows += learn()
        if windows:
            yield done()

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring parts, SUMS of them each, in their order."""
    part, windows, total = None, 0, None
    for batch in batches:
        for k, n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            flat = np.frombuffer(x.as_buffer(), np.float64)
            if part is not None and k // SUMS != part:
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([windows]), pa.array([total.tobytes()], pa.binary())], ["part", "windows", "sums"])
                windows, total = 0, None
            part, windows, total = k // SUMS, windows + n, flat.copy() if total is None else total + flat
    if windows:
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([windows]), pa.array([total.tobytes()], pa.binary())], ["part", "windows", "sums"])


def blocks_of(training: DataFrame, pieces) -> DataFrame:
    """(ids, times): every different block of the texts, by the ids of its pieces, and how often it comes."""
    rows = training.filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(TUNE_TEXTS)) == 0).select("text")
    return rows.mapInArrow(frugal(_draw(1 / TUNE_BLOCKS, pieces)), "ids binary").groupBy("ids").agg(F.count("*").alias("times"))


def tuned(model: attention.Model, pieces: subwords.Pieces, blocks: DataFrame) -> attention.Model:
    """The model after tasks have gone on training it on all blocks (ids, times), each once and weighed by its times.

    The blocks are dealt to parts by their hash, PART_BLOCKS a part or more, and the parts to ROUNDS rounds. Each part
    of a round is trained through in the order of the hashes, from the same start; the next round starts from their
    weights, averaged by windows. So what comes out follows from the texts, not from how rows lie in tasks.
    """
    spark = blocks.sparkSession
    kind = "part long, windows long, sums binary"
    all_parts = min(MOST_PARTS, max(1, blocks.count() // PART_BLOCKS))
    rounds = min(ROUNDS, all_parts)
    h = F.xxhash64("ids", F.lit(6))
    dealt = blocks.withColumn("h", h).withColumn("of_all", F.pmod("h", F.lit(all_parts)))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        parts = len(range(turn, all_parts, rounds))
        with Scratch(spark) as own:
            mine = dealt.filter(F.pmod("of_all", F.lit(rounds)) == turn).withColumn("part", F.floor(F.col("of_all") / rounds))
            mine = mine.repartition(parts, "part").sortWithinPartitions("part", "h", "ids").select("part", "ids", "times")
            sums = own.stored(mine.mapInArrow(frugal(_tune(shared)), kind))
            while parts > SUMS:
                parts = -(-parts // SUMS)
                by_group = sums.withColumn("group", F.floor(F.col("part") / SUMS)).repartition(parts, "group").sortWithinPartitions("group", "part")
                sums = own.stored(by_group.select("part", "windows", "sums").mapInArrow(frugal(_add), kind))
            found = sorted(sums.collect(), key=lambda r: r["part"])
        shared.destroy()
        windows = sum(r["windows"] for r in found)
        if windows:
            total = np.sum([np.frombuffer(r["sums"], np.float64) for r in found], axis=0)
            model = attention.Model(attention.unpacked(total / windows, model.weights), model.groups)
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attention.one_thread()
        s: Scorer = shared.value
        cutter = s.pieces and subwords.Cutter(s.pieces)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at, n in slices(texts):
                data, offsets = flat_bytes(texts.slice(at, n))
                data = lowered(data)
                starts, ends, first = word_spans(data, offsets)
                total, inverse = prefix_hashes(data)
                h = hash_between(total, inverse, starts, ends)
                kinds, where, inverse_of = np.unique(h, return_index=True, return_inverse=True)
                if s.model is None:
                    of_word, of_end = np.zeros(len(h)), np.zeros(n)
                else:
                    ids, counts = cutter.cut(data, starts[where], ends[where], kinds)
                    head = np.cumsum(counts) - counts
                    each = counts[inverse_of]
                    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(head[inverse_of], each)
                    stream, lengths = _streams(s.pieces, ids[place], each, first)
                    logs = attention.score(s.model, stream, lengths).astype(np.float64)
                    tail = np.cumsum(lengths) - 1
                    of_end = logs[tail]
                    inner = np.ones(len(logs), bool)
                    inner[tail] = inner[tail - lengths + 1] = False
                    of_word = np.add.reduceat(logs[inner], np.cumsum(each) - each) if len(each) else np.empty(0)
                k = np.minimum(np.searchsorted(s.hashes, kinds), max(0, len(s.hashes) - 1))
                common = s.hashes[k] == kinds if len(s.hashes) else np.zeros(len(kinds), bool)
                c = np.where(common, s.counts[k], 0)[inverse_of] if len(s.hashes) else np.zeros(len(h), np.int64)
                rare = ~common[inverse_of]
                share = (c + 0.5) / s.divisor
                base = np.where(rare, 0, np.log10(share))
                mixed = np.where(rare, 0, np.log10(MIXTURE * share + (1 - MIXTURE) * np.exp(of_word)))
                row = np.repeat(np.arange(n), np.diff(first))
                end_share = (s.ends + 0.5) / s.divisor
                base_sum = np.bincount(row, base, n) + np.log10(end_share)
                mixed_sum = np.bincount(row, mixed, n) + np.log10(MIXTURE * end_share + (1 - MIXTURE) * np.exp(of_end))
                known = np.diff(np.concatenate([[0], np.cumsum(c > 0)])[first]) + (s.ends > 0)
                bounds = pa.array(np.concatenate([[0], np.cumsum(rare)])[first], pa.int32())
                columns = [x.slice(at, n) for x in batch.columns[:-1]]
                columns += [pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)), pa.array(base_sum), pa.array(mixed_sum)]
                columns += [pa.ListArray.from_arrays(bounds, pa.array(h[rare].view(np.int64))), pa.ListArray.from_arrays(bounds, pa.array(of_word[rare].astype(np.float32)))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_tokens", "n_known", "base", "mixed", "words", "logs"])

    return run


def score(docs: DataFrame, held_out: Column, path: str, text: str = "text", doc_id: str = "doc_id", common: int = COMMON) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Tokens are the words, A-Z lowered, that stand between the bytes 0x20 and 0x09-0x0D, and one end; a null text
    counts as empty. base_score sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens: c a token's count, N
    all, V the different ones in texts that are not held out. score is the model's log10 probability. Repeated rows
    count and are scored as often as they come; held_out null counts as false. Without training texts c, N and V
    are 0 and the attention model gives 1 to everything. Words are told apart by 64-bit hashes. Texts of any length
    count and are scored whole; an empty table gives no rows. Other columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    own = Scratch(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = rows.filter(~F.col("held_out"))
    full = spark.sparkContext.broadcast(subwords.whole(path))
    counted = own.keep(training.select("text").mapInArrow(frugal(_count(full)), "piece boolean, word long, c long").groupBy("piece", "word").agg(F.sum("c").alias("c")))
    counts = counted.filter("not piece").select("word", "c")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = training.count()
    total, kinds = sums["n"] + ends, sums["v"] + (ends > 0)
    divisor = total + 0.5 * (kinds + 1)
    # the commonest words by a histogram of counts, in steps of a sixteenth of a power of two
    step = F.floor(16 * F.log2("c"))
    taken, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        taken += r["count"]
        if taken > common:
            break
        least = r["s"]
    top = counts.filter(step >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    hashes, number = top["word"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(hashes)
    model = pieces = None
    with Scratch(spark) as passing:
        use = counted.filter("piece").toArrow()
        used = np.zeros(full.value.size, np.int64)
        used[use["word"].to_numpy()] = use["c"].to_numpy()
        if used.any():
            pieces = subwords.most_used(path, used, PIECES)
            size = pieces.size + 1
            blocks = passing.stored(blocks_of(training, spark.sparkContext.broadcast(pieces)))
            # as many numbers as there are pairs of pieces, at most
            beside = blocks.mapInArrow(frugal(_pairs(size)), "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()
            pairs = np.zeros(size * size, np.int64)
            pairs[beside["pair"].to_numpy()] = beside["c"].to_numpy()
            # first weights from a bounded number of blocks, before all of them train it
            first = blocks.orderBy(F.xxhash64("ids", F.lit(4)), "ids").limit(-(-START_WORDS // BLOCK_WORDS)).select("ids").toArrow()["ids"]
            first = first.combine_chunks().cast(pa.binary())
            model = train(first.take(pc.sort_indices(first)), pieces, pairs.reshape(size, size))
            model = tuned(model, pieces, blocks)
    shared = spark.sparkContext.broadcast(Scorer(model, pieces, hashes[order], number[order], ends, divisor))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, mixed double, words array<long>, logs array<float>"
    scored = own.keep(rows.mapInArrow(frugal(_score(shared)), schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("words", "logs")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.logs").alias("log"))
    part = (F.coalesce("c", F.lit(0)) + 0.5) / F.lit(divisor)
    rare = rare.join(counts, "word", "left").groupBy("row").agg(
        F.count("c").alias("known"),
        F.sum(F.log10(part)).alias("rare_base"),
        F.sum(F.log10(F.lit(MIXTURE) * part + F.lit(1 - MIXTURE) * F.exp(F.col("log").cast("double")))).alias("rare_mixed"),
    )
    out = scored.drop("words", "logs").join(rare, "row", "left")
    added = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", added("n_known", "known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), added("base", "rare_base").alias("base_score"), added("mixed", "rare_mixed").alias("score"))
