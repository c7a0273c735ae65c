"""Removal of byte strings that repeat anywhere in a corpus, found in suffix arrays.

Every window of `length` bytes has a minimiser, the least hash of the short strings in it, and equal windows
have equal minimisers. Neighbouring windows of a text that share one form a piece. Pieces whose minimiser
stands only once in the corpus can't repeat and go no further; equal pieces travel once, with the number of
their copies. Each task then takes whole groups of pieces with the same minimiser and builds a suffix array
over them in two stages: it sorts only the suffixes that are smaller than their successors, induces the order
of all others by scanning the buckets, and compares neighbours in that order. Windows that share `length`
bytes with a neighbour, or lie in a piece with copies, start repeated strings.

Groups with very many different pieces (say, texts around one passage that all documents quote) are divided
again by a second, independent minimiser, so that no task gets all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import free_names
from folium.llm.scratch import Scratch
from folium.llm.tasks import SLICE, frugal, slices
from folium.llm.windows import chunks, flat_bytes, minimiser_runs, mix

LENGTH = 200
GRAM = 32
#: Groups with more different pieces than this are divided again.
WIDE_GROUP = 1500
#: Bytes of pieces that one suffix array covers, unless a single group is larger.
ARRAY_BYTES = 1 << 19


def suffix_order(pieces: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted suffixes that start the first `windows[k]` bytes of each piece, compared on `length` bytes at least.

    Returns their positions in the pieces laid end to end, those bytes, and where each piece starts. Suffixes end
    with their piece; a suffix that is a prefix of another comes first.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n, ends = len(data), np.cumsum(sizes)
    starts = ends - sizes
    # a suffix is smaller than its successor if its first byte is less than the next other byte
    step = np.zeros(n, np.int8)
    step[:-1][data[:-1] < data[1:]] = 1
    step[:-1][data[:-1] > data[1:]] = -1
    step[ends - 1] = -1
    settled = np.where(step != 0, np.arange(n), n)
    settled = np.minimum.accumulate(settled[::-1])[::-1]
    small = step[settled] > 0
    # of each piece, all positions up to the first small suffix at or after its last window are needed
    next_small = np.where(small, np.arange(n), n)
    next_small = np.append(np.minimum.accumulate(next_small[::-1])[::-1], n)
    until = np.minimum(next_small[starts + windows - 1], ends)
    needed = np.zeros(n + 1, np.int32)
    np.add.at(needed, starts, 1)
    np.add.at(needed, np.minimum(until + 1, ends), -1)
    needed = np.cumsum(needed[:n]) > 0
    # stage 1: sort the small suffixes directly
    direct = np.flatnonzero(small & needed)
    stop = np.minimum(direct + length, np.repeat(ends, sizes)[direct])
    text = data.tobytes().decode("latin-1")
    keys = [text[a:b] for a, b in zip(direct.tolist(), stop.tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)] if len(keys) else direct
    del keys, text
    # stage 2: scan the buckets by first byte; a larger suffix follows its successor into the bucket of its own byte
    heads = np.zeros(n + 1, bool)
    heads[starts] = True
    by_byte = np.argsort(data[direct], kind="stable")
    direct = direct[by_byte]
    bounds = np.searchsorted(data[direct], np.arange(257))
    arriving: list[list[np.ndarray]] = [[] for _ in range(256)]

    def send(bucket: np.ndarray, byte: int) -> None:
        before = bucket[~heads[bucket]] - 1
        first = data[before]
        before, first = before[first > byte], first[first > byte]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        bytes_there, at = np.unique(first, return_index=True)
        for a, x, y in zip(bytes_there.tolist(), at, np.append(at, len(first))[1:], strict=True):
            arriving[a].append(before[x:y])

    # the empty suffixes behind pieces come before everything else
    tails = ends[until == ends] - 1
    for a in np.unique(data[tails]):
        arriving[a].append(tails[data[tails] == a])
    done = []
    for byte in range(256):
        parts = arriving[byte]
        wave = np.concatenate(parts) if parts else np.empty(0, np.int64)
        parts = [wave]
        while len(wave):
            wave = wave[~heads[wave]] - 1
            wave = wave[data[wave] == byte]
            parts.append(wave)
        bucket = np.concatenate([*parts, direct[bounds[byte] : bounds[byte + 1]]])
        if len(bucket):
            send(bucket, byte)
            done.append(bucket)
    order = np.concatenate(done) if done else np.empty(0, np.int64)
    wanted = np.zeros(n + 1, np.int32)
    np.add.at(wanted, starts, 1)
    np.add.at(wanted, starts + windows, -1)
    return order[(np.cumsum(wanted[:n]) > 0)[order]], data, starts


def common_prefixes(order: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """How many bytes, `length` at most, each suffix shares with the one before it in the order; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    words = np.ndarray(len(data) + length, np.dtype("<u8"), padded.data, strides=(1,))
    alive = np.arange(1, len(order))
    for at in range(0, length, 8):
        differ = words[order[alive] + at] ^ words[order[alive - 1] + at]
        ended = differ != 0
        lowest = differ[ended] & (~differ[ended] + np.uint64(1))
        shared[alive[ended]] = at + (np.log2(lowest.astype(np.float64)).astype(np.int64) >> 3)
        alive = alive[~ended]
    shared[alive] = length
    return np.minimum(shared, length)


def repeated_starts(pieces: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each window of the pieces, laid end to end, equals another; and where in that row each piece begins."""
    order, data, starts = suffix_order(pieces, windows, length)
    same = common_prefixes(order, data, length) >= length
    same_next = np.append(same[1:], False)
    flags = np.zeros(len(data) + 1, bool)
    flags[order[same | same_next]] = True
    return flags, starts


def _spans(flags: np.ndarray, length: int) -> list[int]:
    """Start and end of the bytes that flagged windows cover, flat; overlapping ones are joined."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + length], 1).reshape(-1).tolist()


def _scan(length: int, gram: int, with_place: bool):
    """Rows of runs: their minimiser; how often it may stand there, or the run's place and the hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(1))
            out = []
            view = memoryview(np.ascontiguousarray(data))
            for a, b in chunks(offsets, length - 1):
                inner = offsets[(offsets > a) & (offsets < b)] - a
                start, count, value, many = minimiser_runs(data[a:b], np.concatenate([[0], inner, [b - a]]), length, gram)
                start = start + a
                last = [] if not with_place else [xxhash.xxh3_64_intdigest(view[x:y]) for x, y in zip(start.tolist(), (start + count + length - 1).tolist(), strict=True)]
                out.append((start, count, value, many, np.array(last, np.uint64)))
            if not out:
                continue
            start, count, value, many, piece = (np.concatenate(x) for x in zip(*out, strict=True))
            value = pa.array(value.view(np.int64))
            if with_place:
                row = np.searchsorted(offsets, start, "right") - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(start - offsets[row]), pa.array(count), value, pa.array(piece.view(np.int64))], ["cid", "start", "n", "value", "piece"])
            else:
                yield pa.RecordBatch.from_arrays([value, pa.array(many.astype(np.int64) + 1)], ["value", "places"])

    return run


def _divide(length: int, gram: int, wide: int):
    """Cut pieces out of texts. Pieces of wide groups are divided again by the minimisers of shorter strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {k: [] for k in ("key", "value", "piece", "base", "n", "copies", "bytes")}
        schema = pa.schema([(k, pa.binary() if k == "bytes" else pa.int64()) for k in rows])

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_pydict(rows, schema)
            for x in rows.values():
                x.clear()
            return found

        for batch in batches:
            size = 0
            for at in range(batch.num_rows):
                raw = batch.column(0)[at].as_buffer().to_pybytes()
                for w in batch.column(1)[at].as_py():
                    body = raw[w["start"] : w["start"] + w["n"] + length - 1]
                    parts = [(w["value"], 0, w["n"], body)]
                    if w["group"] > wide:
                        flat = np.frombuffer(body, np.uint8)
                        start, count, value, _ = minimiser_runs(flat, np.array([0, len(flat)]), length, gram // 2, 1)
                        keys = mix(value ^ np.uint64(w["value"] % (1 << 64))).view(np.int64)
                        parts = [(k, s, c, body[s : s + c + length - 1]) for k, s, c in zip(keys.tolist(), start.tolist(), count.tolist(), strict=True)]
                    for key, base, n, part in parts:
                        for k, x in zip(rows, (key, w["value"], w["piece"], base, n, w["copies"], part), strict=True):
                            rows[k].append(x)
                    size += len(body)
                if size > SLICE:
                    yield out()
                    size = 0
            yield out()

    return run


def _repeats(length: int):
    """Suffix arrays over whole groups of pieces, which come sorted by key."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        flags, starts = repeated_starts([r[6] for r in rows], np.array([r[4] for r in rows]), length)
        out = [[], [], []]
        for r, a in zip(rows, starts.tolist(), strict=True):
            own = np.ones(r[4], bool) if r[5] > 1 else flags[a : a + r[4]]
            if own.any():
                out[0].append(r[1])
                out[1].append(r[2])
                out[2].append([r[3] + x for x in _spans(own, length)])
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64()))], ["value", "piece", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > ARRAY_BYTES and row[0] != key:
                    yield spans(rows)
                    rows, size = [], 0
                rows.append(row)
                key = row[0]
                size += len(row[6])
        if rows:
            yield spans(rows)

    return run


def _cut(with_text: bool):
    """Join the spans of each text, and take what they leave; columns before text and spans pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at, n in ((b, *x) for b in batches for x in slices(b.column(b.num_columns - 2))):
            batch = whole.slice(at, n)
            out = [[] for _ in range(5)]
            for row in range(n):
                raw, spans = batch.column(batch.num_columns - 2)[row].as_buffer().to_pybytes(), batch.column(batch.num_columns - 1)[row].as_py()
                kept, removed, count, done = [], 0, 0, 0
                for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)) if spans else ():
                    if a > done or not count:
                        kept.append(raw[done:a])
                        count += 1
                        done = a
                    if b > done:
                        removed += b - done
                        done = b
                kept = b"".join([*kept, raw[done:]])
                for column, x in zip(out, (len(raw), removed, count, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if with_text else None), strict=True):
                    column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [*batch.columns[:-2], *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def text_id(text: Column) -> Column:
    """16 bytes that stand for a whole text; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE_GROUP) -> DataFrame:
    """(cid, spans) of those texts among rows (cid, text) that hold repeated strings: flat starts and ends of bytes."""
    spark = texts.sparkSession
    with Scratch(spark) as own:
        # the small side of each join is a table of its own, so that Spark can split a hot value of the other one
        repeated = own.stored(texts.select("cid", "text").mapInArrow(frugal(_scan(length, gram, False)), "value long, places long").groupBy("value").agg(F.sum("places").alias("places")).filter("places > 1").select("value"))
        runs = texts.select("cid", "text").mapInArrow(frugal(_scan(length, gram, True)), "cid binary, start long, n long, value long, piece long")
        members = own.stored(runs.join(repeated, "value", "left_semi").groupBy("cid", "start", "n", "value", "piece").agg(F.count("*").alias("copies")))
        own.drop(repeated)
        pieces = own.stored(members.groupBy("value", "piece").agg(F.sum("copies").alias("copies"), F.min(F.struct("cid", "start", "n")).alias("at")))
        groups = own.stored(pieces.groupBy("value").agg(F.count("*").alias("group")).filter(F.col("group") > wide))
        wanted = pieces.join(groups, "value", "left").select("at.cid", F.struct("at.start", "at.n", "value", "piece", "copies", F.coalesce("group", F.lit(0)).alias("group")).alias("w"))
        distinct = texts.groupBy("cid").agg(F.first("text").alias("text"))
        cuts = distinct.join(wanted.groupBy("cid").agg(F.collect_list("w").alias("wanted")), "cid").select("text", "wanted")
        cuts = cuts.mapInArrow(frugal(_divide(length, gram, wide)), "key long, value long, piece long, base long, n long, copies long, bytes binary")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hits = own.stored(cuts.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(frugal(_repeats(length)), "value long, piece long, spans array<long>"))
        own.drop(pieces)
        spans = members.select("cid", "start", "value", "piece").join(hits, ["value", "piece"]).select("cid", F.transform("spans", lambda x: x + F.col("start")).alias("spans"))
        return own.keep(spans.groupBy("cid").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, wide: int = WIDE_GROUP, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """The columns `keep` of each row with its text's n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text.

    Every byte that lies in a `length`-byte string which starts at another place too, in this or any other row,
    is removed. Null and empty texts, and texts shorter than `length`, lose nothing; a null counts as empty.
    Repeated rows are copies of one another: each loses all bytes if it's long enough. Ids play no part, and may
    be null or repeated. kept_text leaves out bytes of characters that were cut in two. Texts of any length count
    whole; an empty table gives no rows. Of the new columns, those whose names are in `keep` get underscores;
    other columns of docs, whatever their names, play no part.
    """
    named = docs.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), text_id(F.col(text)).alias("cid"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(named.select("cid", "text"), length, gram, wide)
    rows = named.join(spans, "cid", "left").select(*(f"_k{i}" for i in range(len(keep))), "text", "spans")
    kinds = [f"_k{i} {named.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = rows.mapInArrow(frugal(_cut(with_text)), ", ".join([*kinds, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"]))
    names = free_names(keep, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])
    return (out if with_text else out.drop("kept_text")).toDF(*keep, *names[: 4 + with_text])
