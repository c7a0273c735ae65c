"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, and union-find groups.

Documents with equal shingle sets are one class. The classes in a band's bucket are compared with one of them
first, the leader; that joins most of what belongs together. Buckets that still hold more than one component are
then compared inside the tasks, block against block, and give back only the links of a spanning forest. So no
pair list grows with the square of a bucket, and no pair of a bucket that could be a link is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import numbered
from folium.llm.graph import UnionFind, components
from folium.llm.scratch import Scratch
from folium.llm.shingles import band_keys, shingle_sets, signatures
from folium.llm.suffix_dedup import text_id
from folium.llm.tasks import frugal, slices
from folium.llm.windows import flat_bytes

#: Bands of the signature and values in each: two sets with a similarity of 0.8 share a band but for 1 in 100 000.
BANDS, ROWS = 38, 6
#: Members that are compared with a leader in one go.
LED = 400
#: Shingles of all members in one block of a bucket, about.
BLOCK_SHINGLES = 1 << 20
#: Bits a key of the map that sifts rows before a join, and bits of the map at most: 4096 pieces of 4 KB.
SIFT_KEY, SIFT_MOST = 16, 1 << 27


def _sign(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at, n in slices(texts):
                sets = shingle_sets(*flat_bytes(texts.slice(at, n)), size)
                keys = band_keys(signatures(sets, bands * rows), rows).view(np.int64)
                digests = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
                nested = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
                columns = [c.slice(at, n) for c in batch.columns[:-1]]
                columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), nested]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_shingles", "sid", "keys"])

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(1)):
                sets = shingle_sets(*flat_bytes(batch.column(1).slice(at, n)), size)
                ends = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["cid", "shingles"])

    return run


def _led(size: int, percent: int):
    """Links of members with their leaders: rows come sorted so that a leader's own text precedes its members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in batches:
            found: tuple[list, list] = ([], [])
            texts = batch.column(batch.num_columns - 1)
            for at, n in slices(texts):
                part = batch.slice(at, n)
                sets = shingle_sets(*flat_bytes(texts.slice(at, n)), size)
                for lead, member, s in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), sets, strict=True):
                    if member is None:
                        leader, own = lead, s
                    elif lead == leader:
                        both = len(np.intersect1d(own, s, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(s) - both):
                            found[0].append(lead)
                            found[1].append(member)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in found], ["a", "b"])

    return run


def block_links(ids: list, roots: list, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple]:
    """Links that join different components, between members where `left` and members where `right` holds."""
    join = UnionFind()
    for i, r in zip(ids, roots, strict=True):
        join.union(i, r)
    flat = np.concatenate(sets)
    kinds, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1  # a shingle of one member alone is in no intersection
    column = (np.cumsum(counts > 1) - 1)[inverse]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared]
    column, width = column[shared], int((counts > 1).sum())
    sizes = np.array([len(s) for s in sets])
    # one side without the largest component: its members need no comparing with each other
    names, group = np.unique(np.array([join.find(i) for i in ids], object), return_inverse=True)
    del names
    rows, columns = np.flatnonzero(left), np.flatnonzero(right)
    if set(rows.tolist()) == set(columns.tolist()):
        rows = rows[group[rows] != np.bincount(group[rows]).argmax()]
    links = []
    for at in range(0, len(rows), 256):
        some = rows[at : at + 256]
        for to in range(0, len(columns), 1024):
            others = columns[to : to + 1024]
            both = np.zeros((len(some), len(others)), np.float32)
            where = np.full(len(sets), -1)
            for lo in range(0, width, 8192):
                inside = (column >= lo) & (column < lo + 8192)
                o, c = owner[inside], column[inside] - lo
                sides = []
                for side in (some, others):
                    where[:] = -1
                    where[side] = np.arange(len(side))
                    m = np.zeros((len(side), min(8192, width - lo)), np.float32)
                    mine = where[o] >= 0
                    m[where[o[mine]], c[mine]] = 1
                    sides.append(m)
                both += sides[0] @ sides[1].T
            union = sizes[some][:, None] + sizes[others][None, :] - both
            for i, j in zip(*np.nonzero((100 * both >= percent * union) & (group[some][:, None] != group[others][None, :])), strict=True):
                a, b = ids[some[i]], ids[others[j]]
                if join.union(a, b):
                    links.append((a, b))
    return links


def _blocks(percent: int):
    """Links inside buckets: rows come sorted by bucket and pair of blocks."""

    def links(rows: list[tuple]) -> list[tuple]:
        sets = [np.array(r[6], np.int64).view(np.uint64) for r in rows]
        mine = np.array([r[3] for r in rows])
        low, high = rows[0][1], rows[0][2]
        return block_links([r[4] for r in rows], [r[5] for r in rows], sets, mine == low, mine == high, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns[:-1]), (x.values.to_numpy() for x in batch.columns[-1]), strict=True):
                if rows and row[:3] != rows[0][:3]:
                    found += links(rows)
                    rows = []
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])
        if rows:
            found = links(rows)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return run


def sifted(rows: DataFrame, key: str, found: DataFrame, found_key: str) -> DataFrame:
    """The rows whose key is among those found, and a few others: a join with them then deals out little else.

    Every task gets a bitmap of the found keys' hashes, in pieces; it keeps all rows with a found key, whatever its size.
    """
    bits = 1 << 15
    while bits < min(SIFT_MOST, SIFT_KEY * found.count()):
        bits *= 2
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    pieces = found.select(spot(found_key).alias("_spot")).withColumn("_piece", F.bitmap_bucket_number("_spot")).repartition("_piece")
    pieces = pieces.groupBy("_piece").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_bits"))
    place = "int(bitmap_bit_position(_at))"
    hit = f"bit_get(int(conv(hex(substring(_bits, {place} div 8 + 1, 1)), 16, 10)), {place} % 8) = 1"
    marked = rows.withColumn("_at", spot(key))
    return marked.join(F.broadcast(pieces), F.bitmap_bucket_number("_at") == F.col("_piece")).filter(hit).select(rows.columns)


def group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, tid, root) of each row.

    tid is the 16-byte digest of its text, root that of one text of its group; null without shingles.

    Two documents are linked if 100 * intersection >= percent * union of their sets of `size`-word shingles, words
    being what stands between the bytes 0x20 and 0x09-0x0D, A-Z lowered; fewer words are one shingle. The
    component_id is the smallest id of all documents that links reach, kept marks the documents with that id.
    Null and empty texts and texts of white space have no shingles, link with nothing and are kept. Null ids count
    as larger than all others; rows with equal ids stay apart but share the mark. Texts of any length count whole,
    an empty table gives no rows. Other columns of docs, whatever their names, play no part.
    """
    with Scratch(docs.sparkSession) as own:
        named = docs.select(F.col(doc_id).alias("doc_id"), text_id(F.col(text)).alias("tid"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        id_type = named.schema["doc_id"].dataType.simpleString()
        signed = own.stored(named.mapInArrow(frugal(_sign(size, bands, rows)), f"doc_id {id_type}, tid binary, n_shingles long, sid binary, keys array<long>"))
        # a class is named by the least digest of its texts
        classes = signed.filter("sid is not null").groupBy("sid").agg(F.min("tid").alias("cid"), F.min("doc_id").alias("first"), F.first("keys").alias("keys"), F.first("n_shingles").alias("n"))
        classes = own.stored(classes)
        # the small side of each join below is a table of its own, so that Spark can split a hot key of the other one
        places = classes.select(F.explode("keys").alias("key"), "cid", "n")
        leaders = own.stored(places.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("leader"), F.count("*").alias("size")).filter("size > 1").select("key", F.col("leader.cid").alias("leader"), F.col("leader.n").alias("leader_n")))
        members = own.stored(sifted(places, "key", leaders, "key").join(leaders, "key").filter("cid != leader"))
        # 100 i >= p u needs 100 * smaller size >= p * larger size
        possible = F.expr(f"100 * least(n, leader_n) >= {percent} * greatest(n, leader_n)")
        pairs = own.stored(members.filter(possible).select("leader", "cid").distinct())
        led = own.stored(pairs.groupBy("leader").agg(F.ceil(F.count("*") / LED).cast("int").alias("shares")))
        # only texts of classes that meet another one travel
        met = own.stored(members.select("cid").union(members.select("leader")).distinct())
        # no semi-join, which Spark would move ahead of the sifting; met holds each text once
        # grouped by an expression, so that copies are combined before they are dealt anew and a hot text can be split
        texts = own.stored(sifted(named, "tid", met, "cid").join(met, F.col("tid") == F.col("cid")).groupBy(F.substring("tid", 1, 16).alias("tid")).agg(F.first("text").alias("text")))
        none = F.lit(None).cast("binary")
        fronts = led.join(texts, F.col("leader") == F.col("tid")).select("leader", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), none.alias("member"), "text")
        dealt = pairs.join(led, "leader").select("leader", F.pmod(F.xxhash64("cid"), "shares").cast("int").alias("share"), F.col("cid").alias("member"))
        behind = dealt.join(texts, F.col("member") == F.col("tid")).select("leader", "share", "member", "text")
        links = fronts.union(behind).repartition("leader", "share").sortWithinPartitions("leader", "share", F.col("member").asc_nulls_first()).mapInArrow(frugal(_led(size, percent)), "a binary, b binary")
        links = own.stored(links)
        roots = components(links)
        # buckets whose members, the leader aside, are not in one component yet
        lasting = own.stored(members.join(roots, F.col("cid") == F.col("node"), "left").select("key", "cid", "n", F.coalesce("root", "cid").alias("root")))
        open_keys = own.stored(lasting.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")).filter("a != b").select("key", "blocks"))
        rest = own.stored(lasting.join(open_keys, "key"))
        if rest.limit(1).count():
            asked = own.stored(rest.select("cid").distinct())
            wanted = asked.join(texts, F.col("cid") == F.col("tid")).select("cid", "text").mapInArrow(frugal(_full_sets(size)), "cid binary, shingles array<long>")
            rest = rest.withColumn("mine", F.pmod(F.xxhash64("cid", "key"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            rest = rest.select("key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "cid", "root").join(wanted, "cid").select("key", "low", "high", "mine", "cid", "root", "shingles")
            more = rest.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(frugal(_blocks(percent)), "a binary, b binary")
            more = own.stored(more)
            if more.limit(1).count():
                roots = components(links.union(more))
        named_classes = own.stored(classes.join(roots, F.col("cid") == F.col("node"), "left").select("sid", "first", F.coalesce("root", "cid").alias("root")))
        least = own.stored(named_classes.groupBy("root").agg(F.min("first").alias("component_id")))
        named_classes = own.stored(named_classes.join(least, "root").select(F.col("sid").alias("s"), "component_id", "root"))
        out = signed.select("doc_id", "n_shingles", "sid", "tid").join(named_classes, F.col("sid") == F.col("s"), "left")
        component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return own.keep(out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "tid", "root"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The rows of docs without all but one of each group: the one with the smallest id, then the least text digest.

    Rows without shingles stay. Of rows with equal ids and texts in one group any one stays. Columns of docs may have
    any names; an empty table gives no rows.
    """
    rows = numbered(docs)
    at = {c: f"c{docs.columns.index(c)}" for c in (text, doc_id)}
    own = Scratch(docs.sparkSession)
    found = group(rows, at[text], at[doc_id], **how).withColumnRenamed("doc_id", "id")
    first = own.keep(found.filter("root is not null and kept").groupBy("root").agg(F.min(F.struct("tid", "id")).alias("x")).select(F.col("root").alias("of"), F.col("x.tid").alias("first_tid"), F.col("x.id").alias("first_id")))
    stay = found.filter("root is null").select("id", "tid").distinct().withColumn("many", F.lit(False))
    same = [F.col("root") == F.col("of"), F.col("tid") == F.col("first_tid"), F.col("id").eqNullSafe(F.col("first_id"))]
    stay = stay.union(found.join(first, same, "left_semi").groupBy("id", "tid").agg((F.count("*") > 1).alias("many")))
    stay = own.keep(stay)
    rows = rows.withColumn("own_tid", text_id(F.col(at[text]))).join(stay, (F.col("own_tid") == F.col("tid")) & F.col(at[doc_id]).eqNullSafe(F.col("id")))
    if stay.filter("many").limit(1).count():
        rows = rows.filter("not many").unionByName(rows.filter("many").dropDuplicates(["tid", "id"]))
    return rows.select(*(f"c{k}" for k in range(len(docs.columns)))).toDF(*docs.columns)
