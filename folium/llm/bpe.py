"""Byte-pair encoding of whole texts with a public word-end vocabulary, and its decoding.

Words are merged over a doubly linked list of symbols: a priority queue holds the ranks of possible merges, and
entries whose symbols have changed meanwhile are skipped when they come up. Each Python worker keeps the words
that it met lately, so that a common word is merged once.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.columns import free_names
from folium.llm.tasks import frugal, slices

#: Bytes, about, of the words that a Python worker keeps in each of two generations.
KEPT_BYTES = 32 << 20
_HALF = 1 << 32


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordBpe:
    """An encoder for vocabularies with lower-cased words, byte letters and a word-end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = vocabulary | self.special
        self.names = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.names[i] = name
        letters = _byte_letters()
        self.inner = [vocabulary[x] for x in letters]
        self.last = [vocabulary[x + self.end] for x in letters]
        #: (left id, right id) in one number -> (rank, merged id) in one number
        self.merges = {vocabulary[a] << 20 | vocabulary[b]: rank << 20 | vocabulary[a + b] for rank, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in model["merges"])}
        splits = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(splits.replace(r"\s", r"\p{White_Space}"))
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.size = 0

    def merge(self, word: str) -> tuple[int, ...]:
        """The ids of one word."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m >> 20) * _HALF + i for i in range(n - 1) if (m := merges.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), _HALF)
            j = after[i]
            if ids[i] < 0 or j >= n or (m := merges.get(ids[i] << 20 | ids[j])) is None or m >> 20 != rank:
                continue  # one of its symbols has changed since
            ids[i], ids[j] = m & 0xFFFFF, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := merges.get(ids[i] << 20 | ids[k])) is not None:
                    heapq.heappush(queue, (m >> 20) * _HALF + i)
            h = before[i]
            if h >= 0 and (m := merges.get(ids[h] << 20 | ids[i])) is not None:
                heapq.heappush(queue, (m >> 20) * _HALF + h)
        return tuple(x for x in ids if x >= 0)

    def word(self, word: str) -> tuple[int, ...]:
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = self.merge(word)
            if len(word) <= 64:
                if self.size >= KEPT_BYTES:
                    self.old, self.young, self.size = self.young, {}, 0
                self.young[word] = found
                self.size += 200 + len(word) + 8 * len(found)
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text; the special tokens' strings in it become their ids."""
        out: list[int] = []
        for part in self.parts.split(text) if self.parts and "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # each letter is lowered by itself
            out.extend(itertools.chain.from_iterable(map(self.word, self.words.findall(part.lower()))))
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings one after another, with a blank between them."""
        return " ".join(map(self.names.__getitem__, ids))


@functools.lru_cache(1)
def encoder(path: str) -> WordBpe:
    """One encoder for each Python worker, of the path used last."""
    return WordBpe(path)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at, n in slices(texts):
                ids = [bpe.encode(x or "") for x in texts[at : at + n].to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(ends[-1]))
                columns = [c.slice(at, n) for c in batch.columns[:-1]]
                columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(list(map(bpe.decode, ids)), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row, the ids of its whole text, and `decoded`, the text of those ids.

    A null text counts as empty; it and texts of white space alone have no ids. Order and number of rows stay,
    repeated rows too, and an empty table gives none. Texts of any length are encoded whole. Other columns of docs,
    whatever their names, play no part; `ids` and `decoded` get underscores if `keep` has these names.
    """
    names = free_names(keep, ("ids", "decoded"))
    rows = docs.select(*(F.col(c).alias(f"c{k}") for k, c in enumerate(keep)), F.col(text).alias("text"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "ids array<int>", "decoded string"])
    return rows.mapInArrow(frugal(_encode(path)), schema).toDF(*keep, *names)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of encode()'s rows."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(ids, 256), "decoded_sha256": F.sha2("decoded", 256)}).drop("ids", "decoded")
