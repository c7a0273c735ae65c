"""Words cut into the pieces of a public vocabulary, longest first, many words at a time."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

from folium.llm.bpe import _byte_letters
from folium.llm.windows import hash_between, mix, prefix_hashes

_END = np.uint64(0xA0761D6478BD642F)
LONGEST = 6
#: Words that a Cutter remembers at once, and pieces of them after which it forgets all.
SLOTS, POOL = 1 << 20, 1 << 22


@dataclass
class Pieces:
    """Sorted hashes of pieces, their ids, and the length of the longest. Ids 2b and 2b + 1 are byte b inside and at the end of a word.

    `begins` says of the first bits of a hash, after `shift` to the right, whether a piece's hash begins so.
    """

    hashes: np.ndarray
    ids: np.ndarray
    longest: int
    size: int
    begins: np.ndarray
    shift: np.uint64

    @property
    def border(self) -> int:
        """The id that begins and ends texts."""
        return self.size


def _hashes(pieces: list[tuple[bytes, bool]]) -> np.ndarray:
    data = np.frombuffer(b"".join(p for p, _ in pieces), np.uint8)
    ends = np.cumsum([len(p) for p, _ in pieces])
    starts = ends - [len(p) for p, _ in pieces]
    total, inverse = prefix_hashes(data)
    return mix(hash_between(total, inverse, starts, ends) ^ np.where([e for _, e in pieces], _END, np.uint64(0)))


def _table(pieces: list[tuple[bytes, bool]]) -> Pieces:
    single = [(bytes([b]), e) for b in range(256) for e in (False, True)]
    pieces = single + [p for p in dict.fromkeys(pieces) if len(p[0]) > 1]
    hashes = _hashes(pieces)
    order = np.argsort(hashes)
    bits = (32 * len(pieces)).bit_length()
    begins, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
    begins[hashes >> shift] = True
    return Pieces(hashes[order], order, max(len(p) for p, _ in pieces), len(pieces), begins, shift)


def vocabulary(path: str) -> list[tuple[bytes, bool]]:
    """The vocabulary's pieces of 2 to LONGEST bytes: their bytes, and whether they end a word."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte, end = {c: b for b, c in enumerate(_byte_letters())}, model["end_of_word_suffix"]
    out = []
    for name in model["vocab"]:
        ends = name.endswith(end)
        raw = bytes(byte[c] for c in (name[: -len(end)] if ends else name))
        if 2 <= len(raw) <= LONGEST:
            out.append((raw, ends))
    return out


def cut(pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words data[starts:ends], one word after another, and the number of pieces of each."""
    total, inverse = prefix_hashes(data)
    at, open_ = starts.copy(), np.arange(len(starts))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(open_):
        here, end = at[open_], ends[open_]
        ids, size = np.full(len(open_), -1), np.zeros(len(open_), np.int64)
        for n in range(pieces.longest, 0, -1):
            left = np.flatnonzero((ids < 0) & (here + n <= end))
            stop = here[left] + n
            h = mix(hash_between(total, inverse, here[left], stop) ^ np.where(stop == end[left], _END, np.uint64(0)))
            # most are no pieces, which their first bits tell
            maybe = pieces.begins[h >> pieces.shift]
            left, h = left[maybe], h[maybe]
            k = np.minimum(np.searchsorted(pieces.hashes, h), len(pieces.hashes) - 1)
            hit = pieces.hashes[k] == h
            ids[left[hit]], size[left[hit]] = pieces.ids[k[hit]], n
        found.append((open_, ids))
        at[open_] += size
        open_ = open_[at[open_] < end]
    counts = np.zeros(len(starts), np.int64)
    for o, _ in found:
        counts[o] += 1
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for turn, (o, ids) in enumerate(found):
        out[first[o] + turn] = ids
    return out, counts


class Cutter:
    """Cuts words as cut() does, but those that it remembers, by their 64-bit hashes, only once.

    Each word has one place to be remembered at, which the last one takes, so memory doesn't grow with the words.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._hashes, self._at, self._counts = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self._ids, self._used = np.empty(POOL, np.int32), 0

    def cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the number of pieces of different words with these hashes."""
        if self._used > POOL:
            self.__init__(self.pieces)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        at, counts = self._at[slot].astype(np.int64), self._counts[slot].astype(np.int64)
        new = np.flatnonzero((self._hashes[slot] != hashes) | (counts == 0))
        if len(new):
            ids, counts[new] = cut(self.pieces, data, starts[new], ends[new])
            at[new] = self._used + np.cumsum(counts[new]) - counts[new]
            if self._used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids[: self._used], np.empty(len(ids) + POOL, np.int32)])
            self._ids[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
            # of new words that share a place the last one remains, in all three
            for kept, values in ((self._hashes, hashes), (self._at, at), (self._counts, counts)):
                kept[slot[new]] = values[new]
        place = np.arange(counts.sum()) + np.repeat(at - np.cumsum(counts) + counts, counts)
        return self._ids[place].astype(np.int64), counts


def whole(path: str) -> Pieces:
    """All pieces of the vocabulary, besides all single bytes."""
    return _table(vocabulary(path))


def chosen(path: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> Pieces:
    """The `size` pieces that words use most, besides all single bytes."""
    full = whole(path)
    ids, _ = cut(full, data, starts, ends)
    return most_used(path, np.bincount(ids, minlength=full.size), size)


def most_used(path: str, counts: np.ndarray, size: int) -> Pieces:
    """The same by how often words use each of the whole vocabulary's pieces."""
    counts = counts.copy()
    counts[:512] = 0
    best = np.argsort(-counts, kind="stable")[:size]
    every = [p for p in dict.fromkeys(vocabulary(path)) if len(p[0]) > 1]
    return _table([every[i - 512] for i in best.tolist() if counts[i]])
