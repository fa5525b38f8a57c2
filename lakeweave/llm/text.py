"""Vectorised views of text columns: bytes, words and polynomial hashes over Arrow buffers.

Words are runs of anything but the bytes 0x20 and 0x09-0x0D. All helpers work on whole texts; long columns are
cut into slices of rows so that temporary arrays stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Slice:
    """Rows ``first`` to ``last`` of a column: their bytes end to end and the offset of each row."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.data[self.offsets[i]:self.offsets[i + 1]]

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string or binary column into slices of about ``limit`` bytes, one row at least. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null(b"")
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        start = offsets[first]
        yield Slice(first, last, data[start:offsets[last]], offsets[first:last + 1] - start)
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words never cross rows."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    global _CACHE
    if len(_CACHE[0]) < n:
        size = max(n, 2 * len(_CACHE[0]), 1 << 16)
        both = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            with np.errstate(over="ignore"):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
        _CACHE = tuple(both)
    return _CACHE[0][:n], _CACHE[1][:n]


_CACHE: tuple = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class RangeHash:
    """Position-free 64-bit hashes of any byte range of one buffer, in constant time each."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[data] * powers[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
            return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
