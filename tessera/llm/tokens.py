"""Word hashing over whole Arrow text columns (NumPy, no per-word Python).

A *word* is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. All of these are
single ASCII bytes, so splitting UTF-8 bytes equals splitting characters. Every
function here works on one slice of rows at a time, cut so that a slice holds at
most ``slice_bytes`` of text (one longer text forms a slice of its own); memory is
bounded by that size, not by the number of rows in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Small, so that a worker's arrays (eight bytes and more for each of text, several at once) stay at a few MB.
SLICE_BYTES = 1 << 18
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)


class Slice(NamedTuple):
    """Rows ``first..last`` of a column: word hashes, and per row the index of its first word."""
    first: int
    last: int
    hashes: np.ndarray  # uint64, one per word
    starts: np.ndarray  # int64, last - first + 1 entries; row i has words starts[i]:starts[i+1]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective); different salts give independent-looking hashes."""
    x = x ^ np.uint64((salt * _MULT) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _byte_table(lower: bool, salt: int) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64), 77 + salt)
    if lower:
        table[65:91] = table[97:123]
    return table


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse modulo 2**64."""
    if len(_POWERS[0]) <= n:
        size = 1 << max(n, SLICE_BYTES + 16).bit_length()
        for i, base in enumerate((_MULT, _INV)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _POWERS[i] = np.cumprod(out)
    return _POWERS[0], _POWERS[1]


def _layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte values and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, slice_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges holding at most ``slice_bytes`` each, or one longer row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_slices(column: pa.Array, lower: bool = False, salt: int = 0,
                slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Hash every word of every row; ``lower`` folds A-Z only."""
    data, offsets = _layout(column)
    table = _byte_table(lower, salt)
    for first, last in row_slices(offsets, slice_bytes):
        b = data[offsets[first]:offsets[last]]
        off = offsets[first:last + 1] - offsets[first]
        begin, end = word_bounds(b, off)
        pw, inv = _powers(len(b))
        sums = np.empty(len(b) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(table[b] * pw[:len(b)], out=sums[1:])
        hashes = mix((sums[end] - sums[begin]) * inv[begin])
        yield Slice(first, last, hashes, np.searchsorted(begin, off))


def word_bounds(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end byte of every word; a row boundary always ends a word."""
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.zeros(len(b) + 1, dtype=bool)
    edge[off] = True
    before = np.ones(len(b), dtype=bool)
    after = np.ones(len(b), dtype=bool)
    if len(b):
        before[1:] = ~inside[:-1]
        after[:-1] = ~inside[1:]
    begin = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return begin, end


def windows(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each position on, ignoring row ends (the caller masks them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    pw, inv = _powers(len(hashes))
    sums = np.empty(len(hashes) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(hashes * pw[:len(hashes)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * inv[:n], k + 1000 * salt)


def window_owner(starts: np.ndarray, k: int) -> np.ndarray:
    """Start positions of the ``k``-word windows that lie inside one row."""
    room = np.maximum(np.diff(starts) - k + 1, 0)
    total = int(room.sum())
    skipped = np.repeat(starts[:-1] - (np.cumsum(room) - room), room)
    return np.arange(total) + skipped
