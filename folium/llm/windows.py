"""Vectorised helpers on UTF-8 bytes: rolling hashes and runs of windows that share a minimiser."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multiplier of the rolling polynomial hash; its inverse modulo 2**64 is derived below.
_R = 0x9E3779B97F4A7C15
#: Bytes that the helpers take at a time, so that their arrays stay in a core's cache.
CHUNK = 1 << 18


def flat_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array end to end, and its offsets (one more than rows); nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, overlap: int, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Byte ranges that cover all rows: whole rows up to `size` together, longer rows in parts that share `overlap` bytes."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = max(int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1, row + 1)
        start, end = int(offsets[row]), int(offsets[last])
        if end - start <= 2 * size:
            if end > start:
                yield start, end
        else:
            while end - start > overlap:
                yield start, min(end, start + size + overlap)
                start += size
        row = last


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words, so that the order of hashes says nothing about the text."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


@functools.lru_cache(2)
def _powers(n: int, base: int) -> np.ndarray:
    power = np.full(n, np.uint64(base))
    power[0] = 1
    return np.multiply.accumulate(power, out=power)


def forget() -> None:
    """Let go of the tables that hashing has left."""
    _powers.cache_clear()


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial hash and powers of the inverse multiplier, for hash_between()."""
    n = len(data)
    size = max(1 << n.bit_length(), 4 * CHUNK)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * _powers(size, _R)[:n], out=total[1:])
    return total, _powers(size, pow(_R, -1, 1 << 64))


def hash_between(total: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte string data[start:end]; it depends on the bytes and their number alone."""
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbouring values, in time that does not depend on the width."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def minimiser_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, seed: int = 0):
    """Runs of neighbouring `length`-byte windows, within a row of `offsets`, whose least `gram`-byte hash is the same.

    Returns first window start (in data), number of windows, that least hash, and whether the hash stands
    more than once within the run's bytes. Equal windows always fall into runs of an equal hash.
    """
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none.astype(bool)
    total, inverse = prefix_hashes(data)
    h = mix(((total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1]) ^ np.uint64(seed))
    width = length - gram + 1
    low = sliding_least(h, width)
    whole = np.ones(len(low), bool)
    for end in offsets[1:-1].tolist():
        whole[max(0, end - length + 1) : end] = False
    first = np.ones(len(low), bool)
    np.not_equal(low[1:], low[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < len(low)]] = True
    starts = np.flatnonzero(first & whole)
    stop = np.flatnonzero(first | ~whole)
    ends = np.append(stop, len(low))[np.searchsorted(stop, starts, "right")]
    value = low[starts]
    # places that carry the least hash of some window over them; a run may hold several with its own hash
    edge = np.full(width - 1, np.iinfo(np.uint64).max, np.uint64)
    place = np.flatnonzero(h == ~sliding_least(np.concatenate([edge, ~low, edge]), width))
    lo, hi = np.searchsorted(place, starts), np.searchsorted(place, ends - 1 + width)
    counts = hi - lo
    index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
    owner = np.repeat(np.arange(len(starts)), counts)
    many = np.bincount(owner[h[place[index]] == value[owner]], minlength=len(starts)) > 1
    return starts, ends - starts, value, many
