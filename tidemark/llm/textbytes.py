"""Words of whole Arrow text columns, found and hashed on their bytes with numpy.

A word is a longest run without the bytes 9 to 13 and 32. Texts are taken in pieces of about
``PIECE`` bytes, always whole texts, so the memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_ONE = np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


def pieces(column, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    raw, offsets = column_bytes(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), first + 8192, rows)
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


class _Known(dict):
    """What a process has worked out. Functions go to tasks with their defaults; this goes there empty."""

    def __reduce__(self):
        return type(self), ()


def _powers(n: int, base: int, known=_Known()) -> np.ndarray:  # noqa: B008
    have = known.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 1), base, np.uint64)
        have[0] = 1
        have = known[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span: a polynomial in its bytes from prefix sums, then scrambled with the length."""
    n = len(raw)
    base = (_STEP + 2 * seed) | 1
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + _ONE) * _powers(n, base), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(n + 1, inverse)[starts]
    return mix(value ^ (np.uint64(_STEP) * (ends - starts).astype(np.uint64)))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``word_hashes`` of spans in order, about ``PIECE`` bytes at a time: the same values in less memory."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        last = max(int(np.searchsorted(starts, starts[first] + PIECE)), first + 1)
        a, b = int(starts[first]), int(ends[last - 1])
        out[first:last] = word_hashes(raw[a:b], starts[first:last] - a, ends[first:last] - a)
        first = last
    return out


def lengths_by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)
