"""How the sources of a language differ in their words: divergences of each source from the others and from the whole.

Every task folds whole documents into stripes: of a term, the number of documents that hold it and its count in each
source. Stripes are handed on when they fill the memory they may have, merged by term, and give the divergences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.llm.scratch import Scratch
from folium.llm.tasks import frugal, slices

#: A term counts where at least this many documents of the language hold it.
MIN_DOCS = 10
#: Terms listed for each source.
TOP = 10
SCALE = 1_000_000_000
#: Bytes that a task's stripes may hold, by an estimate, before they are handed on.
MEMORY = 96 << 20
#: Bytes of a text whose terms are split off at once.
PIECE = 1 << 20
#: Pairs of sources that a task adds up before it hands the sums on.
PAIRS = 1 << 17

#: Letters, lowered, and all bytes of other characters than ASCII stay; the rest parts terms.
_TERM_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a text, which is split piece by piece between terms."""
    text, found, at = text.translate(_TERM_BYTES), Counter(), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            cut = cut if cut > at else text.find(b" ", end)
            end = cut if cut > at else len(text)
        found.update(text[at:end].split())
        at = end
    return found


def _handed_on(stripes: dict[str, dict[bytes, list]], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """The stripes as rows of lang, term, document frequency and the counts by source; they are emptied."""
    names = ["lang", "term", "docs", "sources", "counts"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
    while stripes:
        lang, terms = stripes.popitem()
        items = list(terms.items())
        del terms
        for at in range(0, len(items), rows):
            some = items[at : at + rows]
            columns = [[lang] * len(some), [t.decode("utf-8", "replace") for t, _ in some], [s[0] for _, s in some], [list(s[1]) for _, s in some], [list(s[1].values()) for _, s in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _fold(memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, list]] = {}
        size = 0
        for batch in batches:
            for row, n in slices(batch.column(2)):
                part = batch.slice(row, n)
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    terms = stripes.setdefault(lang, {})
                    for term, count in term_counts(text).items():
                        stripe = terms.get(term)
                        if stripe is None:
                            terms[term] = [1, {source: count}]
                            size += 420 + len(term)
                        else:
                            stripe[0] += 1
                            by_source = stripe[1]
                            if source in by_source:
                                by_source[source] += count
                            else:
                                by_source[source] = count
                                size += 64
                    if size > memory:
                        yield from _handed_on(stripes)
                        stripes, size = {}, 0
        yield from _handed_on(stripes)

    return run


def stripes(docs: DataFrame, min_docs: int = MIN_DOCS, memory: int = MEMORY) -> DataFrame:
    """lang, term, docs (how many hold it) and cells, the counts by source, of terms in at least min_docs documents.

    `docs` has the columns lang, source and text without nulls. What tasks hand on is shuffled once, by term: a
    term has one row for each task and spill, however often it stands in the texts, and one cell for each source.
    """
    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    handed = rows.mapInArrow(frugal(_fold(memory)), "lang string, term string, docs long, sources array<string>, counts array<long>")
    cells = handed.repartition("lang", "term").select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "cell"))
    cells = cells.groupBy("lang", "term", F.col("cell.sources").alias("source")).agg(F.sum("cell.counts").alias("n"), F.sum(F.expr("if(at = 0, docs, 0)")).alias("docs"))
    merged = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return merged.filter(F.col("docs") >= min_docs)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact for counts of any size."""
    part = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    whole = (total + 2 * terms).cast("decimal(20,0)")
    return F.call_function("div", part, whole) + 1


def _gap(p: str, q: str) -> str:
    """Of two shares, floor((p - q)^2 / (p + q)), as SQL."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stripes of shares: for each two sources, summed over the terms that both have, how far the gap between
    them differs from what each would add beside a source without the term."""
    sums: dict[tuple[str, str, str], int] = {}

    def handed() -> pa.RecordBatch:
        keys = list(zip(*sums, strict=True)) if sums else [[], [], []]
        return pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys), pa.array(list(sums.values()), pa.int64())], ["lang", "a", "b", "value"])

    for batch in batches:
        lists = batch.column(1)
        flat, owner = lists.flatten(), lists.value_parent_indices().to_numpy().astype(np.int64)
        source, lang = flat.field("source").dictionary_encode(), batch.column(0).dictionary_encode()
        langs, names = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        order = np.argsort(np.argsort(np.array([x.encode() for x in names], object))) if names else np.zeros(0, np.int64)
        names = sorted(names, key=str.encode)
        code = order[source.indices.to_numpy()] if len(source) else order
        of_lang = lang.indices.to_numpy()[owner] if len(owner) else owner
        p, base = (flat.field(c).to_numpy() for c in ("p", "base"))
        for shift in range(1, int(np.bincount(owner).max()) if len(owner) else 0):
            i = np.flatnonzero(owner[shift:] == owner[:-shift])
            j = i + shift
            value = _gaps(p[i], p[j]) - _gaps(p[i], base[j]) - _gaps(base[i], p[j]) + _gaps(base[i], base[j])
            a, b = np.minimum(code[i], code[j]), np.maximum(code[i], code[j])
            keys, back = np.unique((of_lang[i].astype(np.int64) * len(names) + a) * len(names) + b, return_inverse=True)
            added = np.zeros(len(keys), np.int64)
            np.add.at(added, back, value)
            for k, v in zip(keys.tolist(), added.tolist(), strict=True):
                key = (langs[k // len(names) // len(names)], names[k // len(names) % len(names)], names[k % len(names)])
                sums[key] = sums.get(key, 0) + v
            if len(sums) > PAIRS:
                yield handed()
                sums.clear()
    yield handed()


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank of the sources' divergences.

    A language's terms are runs of letters and of characters beyond ASCII, A-Z lowered, that at least min_docs of its
    documents hold. Each source of the language, and the language as a whole, gives each of those a share p = 1 +
    floor(SCALE * (n + 2) / (N + 2 * V)), n its count there, N all of them and V the terms' number; two shares differ
    by floor((p - q)^2 / (p + q)). Part `pair`: the item is each other source of the language, the value the sum over all
    terms. Part `term`: the item is each term of the source whose share is above the language's, the value the
    difference, and the first `top` stay. Rank goes by falling value, then by the item's bytes.

    Null texts, languages and sources are empty strings, and those are a language and a source like others. A source
    without terms has rows too; one without others in its language has no pairs. Repeated rows are documents of
    their own, texts of any length are read whole, no rows give none, and other columns play no part.
    """
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "text"))))
    own = Scratch(docs.sparkSession)
    merged = own.keep(stripes(rows, min_docs))
    cells = merged.select("lang", "term", F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("lang_n"), F.explode("cells").alias("cell"))
    cells = cells.select("lang", "term", "lang_n", F.col("cell.source").alias("source"), F.col("cell.n").alias("n"))
    # a row for each source of a language; sources without a term come from the documents
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    terms = merged.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("lang_total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0)
    some = F.col("terms") > 0
    groups = own.keep(groups.withColumn("base", F.when(some, _share(F.lit(0), F.col("total"), F.col("terms")))))

    shares = cells.join(groups, ["lang", "source"])
    shares = own.keep(shares.select("lang", "term", "source", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"), "base"))

    above = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_gap("p", "q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    # over all terms: both lack the term, one of them does, or (corrected from the stripes) both have it
    others = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("base_2"), F.col("held").alias("held_2"))
    alone = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n")).join(others, "lang").filter("source != item")
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(F.expr(f"n * ({_gap('p', 'base_2')})")).alias("value"))
    of_stripes = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("cells"))
    both = of_stripes.select("lang", "cells").mapInArrow(frugal(_pair_sums), "lang string, a string, b string, value long")
    both = both.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    either = lambda df, x, y: df.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value")
    parts = [alone, either(alone, "item", "source"), either(both, "a", "b"), either(both, "b", "a")]
    neither = groups.join(others, "lang").filter("source != item")
    parts.append(neither.select("lang", "source", "item", F.expr(f"if(terms = 0, 0, (terms - held - held_2) * ({_gap('base', 'base_2')}))").alias("value")))
    pairs = parts[0]
    for x in parts[1:]:
        pairs = pairs.unionByName(x)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    return pairs.unionByName(above)
