"""Word shingles of whole texts as sets of 64-bit hashes, and SuperMinHash signatures of such sets."""

from __future__ import annotations

import numpy as np

from folium.llm.windows import hash_between, mix, prefix_hashes

#: Bytes that part words: 0x20 and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CASE = np.arange(256, dtype=np.uint8)
_CASE[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and the number of the first word of each row (one more than rows)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    blank = _SPACE[data]
    starts = np.empty(len(data), bool)
    starts[0] = not blank[0]
    starts[1:] = ~blank[1:] & blank[:-1]
    ends = np.empty(len(data), bool)
    ends[-1] = not blank[-1]
    ends[:-1] = ~blank[:-1] & blank[1:]
    for at in offsets[1:-1].tolist():  # a word ends with its row
        if 0 < at < len(data) and not blank[at - 1] and not blank[at]:
            starts[at] = ends[at - 1] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, A-Z lowered, and the number of the first word of each row (one more than rows)."""
    starts, ends, first = word_spans(data, offsets)
    total, inverse = prefix_hashes(lowered(data))
    return hash_between(total, inverse, starts, ends), first


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lowered."""
    return _CASE[data]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row the sorted hashes of its different runs of `size` words; of all its words, if it has fewer."""
    h, first = words(data, offsets)
    runs = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        runs = mix(runs * np.uint64(3) + h[k : k + len(runs)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = mix(one * np.uint64(3) + h[k : k + 1])
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash: for each set m values, of which two sets share about the share that is their similarity.

    Every element ranks the m places in a random order and offers its r-th place a value between r and r + 1, so
    its offers differ from place to place; the least offer stays. A set is done, and its elements go no further,
    as soon as all its values are below the next rank.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    element = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    least = np.full((n, m), np.inf)
    flat = least.reshape(-1)
    order = None
    for rank in range(m):
        if not len(element):
            break
        drawn = mix(element + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
        offer = (drawn >> np.uint64(24)).astype(np.float64) / 2.0**40 + rank
        swap = rank + ((drawn & np.uint64(0xFFFFFF)) * np.uint64(m - rank) >> np.uint64(24)).astype(np.int64)
        if rank == 0:
            place = swap
        else:
            if order is None:  # only sets that the first rank didn't fill get here: they have few elements
                order = np.tile(np.arange(m, dtype=np.int16), (len(element), 1))
                order[np.arange(len(element)), first], order[:, 0] = 0, first
            row = np.arange(len(element))
            place = order[row, swap].astype(np.int64)
            order[row, swap] = order[:, rank]
            order[:, rank] = place
        np.minimum.at(flat, owner * m + place, offer)
        stay = (least.max(axis=1) > rank + 1)[owner]
        if rank == 0:
            first = swap[stay]
        element, owner = element[stay], owner[stay]
        if order is not None:
            order = order[stay]
    return least


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` values; the same values in another band give another key."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    keys = np.tile(np.arange(bits.shape[1], dtype=np.uint64), (len(signature), 1))
    for k in range(rows):
        keys = mix(keys * np.uint64(5) + bits[:, :, k])
    return keys
