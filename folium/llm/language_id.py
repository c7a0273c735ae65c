"""Language identification by compression: the language whose dictionary makes a text smallest.

The dictionaries are raw zstandard content, a bounded sample of labelled texts for each language.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import free_names
from folium.llm.tasks import frugal, slices

#: Texts, and characters of each, that a language's dictionary holds at most.
SAMPLE_TEXTS, SAMPLE_CHARS = 96, 1200
#: Texts of fewer characters teach only where a language has fewer than SAMPLE_TEXTS others.
SHORT_CHARS = 40
#: zstandard's level, for texts of every length.
LEVEL = 6
#: Bytes of a text that are compressed at once. A dictionary saves a bounded number of them, so that without blocks
#: the margin would fall with a text's length.
BLOCK = 1 << 14
#: Texts that win by a smaller share of their size than this are rejected.
MIN_MARGIN = 0.004


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The words of a text in lower case, with one blank for whatever stands between them."""
    return _OTHER.sub(" ", text.lower())


def dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """For each language, the starts of a bounded sample of its different texts; the sample is dealt by the texts' hash.

    A language has min(SAMPLE_TEXTS, its different texts) in it, however often each occurs; texts under SHORT_CHARS
    characters come after all longer ones. Rows without a letter or a language teach nothing. The rows come back to
    the driver: SAMPLE_TEXTS * SAMPLE_CHARS characters a language.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", (F.length("text") < SHORT_CHARS).alias("short"), F.xxhash64("text", F.lit(6)).alias("h"))
    counts = {(r["lang"], r["short"]): r["n"] for r in rows.select("lang", "short", "h").distinct().groupBy("lang", "short").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # enough texts of each language pass the hash; the cut to the exact number is then on few rows
    passing = {k: min(1.0, 4 * SAMPLE_TEXTS / n) for k, n in counts.items() if not k[1] or counts.get((k[0], False), 0) < SAMPLE_TEXTS}
    share = lambda short: F.create_map(*(F.lit(x) for k in sorted({k for k, _ in counts}) for x in (k, passing.get((k, short), 0.0))))[F.col("lang")]
    passes = (F.col("h") / F.lit(2.0**64) + 0.5) < F.when(F.col("short"), share(True)).otherwise(share(False))
    drawn = rows.filter(passes).select("lang", "short", "h", F.substring("text", 1, SAMPLE_CHARS).alias("text")).distinct()
    texts: dict[str, list] = {k: [] for k in sorted({k for k, _ in counts})}
    for r in drawn.collect():
        texts[r["lang"]].append((r["short"], r["h"], r["text"]))
    return {k: letters("\n".join(t for _, _, t in sorted(x)[:SAMPLE_TEXTS])).encode() for k, x in texts.items()}


class Compressors:
    """The sizes of a text under each language's dictionary."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        self.ways = []
        for k in self.langs:
            known = zstandard.ZstdCompressionDict(samples[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.ways.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False))

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language and its margin: the share by which the next best size is larger. `und` without a letter."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        raw = letters(text).encode()
        blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(x)) for x in blocks), i) for i, c in enumerate(self.ways))
        best = sizes[0][0]
        rival = sizes[1][0] if len(sizes) > 1 else 2 * best
        return self.langs[sizes[0][1]], min(1.0, max(0.0, (rival - best) / rival))


@functools.lru_cache(1)
def _compressors(samples: tuple[tuple[str, bytes], ...]) -> Compressors:
    return Compressors(dict(samples))


def _judge(shared, at: int, kept: int):
    """Languages of the texts in column `at`; the first `kept` columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _compressors(tuple(shared.value.items())).judge
        for batch in batches:
            for row, n in slices(batch.column(at)):
                part = batch.slice(row, n)
                found = [judge(x) for x in part.column(at).to_pylist()]
                columns = [*part.columns[:kept], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:kept], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, samples: dict[str, bytes], text: str = "text", keep: tuple[str, ...] = ("doc_id",), min_margin: float = MIN_MARGIN) -> DataFrame:
    """The columns `keep` of every row with lang_pred, score (the margin, 0 to 1) and accepted.

    A text that is null or has no letter gets `und` and 0; so does every text if nothing was learned. Of equal
    sizes the first language in order wins, with score 0. accepted is false for `und` and for narrow margins.
    Every row is judged by itself, repeated ones too, on its whole text of any length; an empty table gives none.
    Of the new columns, those whose names are in `keep` get underscores; other columns of docs play no part.
    """
    names = free_names(keep, ("lang_pred", "score", "accepted"))
    own = [F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]
    rows = docs.select(*own) if text in keep else docs.select(*own, F.col(text).alias("text"))
    at = keep.index(text) if text in keep else len(keep)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)]), "lang_pred string, score double"])
    judge = frugal(_judge(docs.sparkSession.sparkContext.broadcast(samples), at, len(keep)), _compressors.cache_clear)
    found = rows.mapInArrow(judge, schema)
    return found.withColumn("accepted", (F.col("lang_pred") != "und") & (F.col("score") >= min_margin)).toDF(*keep, *names)


def fold(column: Column, n: int) -> Column:
    """crc32 of a value's text, modulo n; null for null."""
    return F.crc32(column.cast("string").cast("binary")) % n
