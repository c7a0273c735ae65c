"""What the functions that run inside tasks share: slices of bounded size, and memory given back at the end of a task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from folium.llm.windows import flat_bytes, forget

#: Bytes of text that a task turns into Python objects or arrays at once, unless a single text is longer.
SLICE = 1 << 19


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """First row and number of rows of slices that hold `size` bytes of text at most, or one longer text."""
    offsets = flat_bytes(texts)[1]
    row, rows = 0, len(texts)
    while row < rows:
        last = max(int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1, row + 1)
        yield row, last - row
        row = last


def frugal(run: Callable, *clear: Callable) -> Callable:
    """A function for mapInArrow that gives its memory back when a task ends, after it has called `clear`.

    Spark's Python workers serve many tasks of many steps; what one step keeps, the executor lacks for all others.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for f in (forget, *clear):
                f()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task
