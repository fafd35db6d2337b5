"""Words of many texts at once, as Arrow arrays and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Fixed odd factor of the polynomial that spreads words over the buckets.
FACTOR = 0x9E3779B97F4A7C15
_AT_ONCE = 1 << 16

_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\v\f\r")] = True


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array, and where each of its values starts and ends."""
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[ends[0]:ends[-1]], ends - ends[0]


def words_of(texts: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as one binary array, and the number of words of each text.

    ``table`` replaces bytes first (256 of them, as in ``bytes.translate``).
    """
    data, ends = bytes_of(texts)
    if table is not None:
        data = np.frombuffer(table, np.uint8)[data]
    inside = ~_BLANK[data]
    # A byte begins (ends) a word if the one before (after) it is a blank or of another text.
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    full = ends[:-1] < ends[1:]
    begins[ends[:-1][full]] = inside[ends[:-1][full]]
    stops[ends[1:][full] - 1] = inside[ends[1:][full] - 1]
    starts = np.flatnonzero(begins)
    offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(stops) + 1 - starts))).astype(np.int32)
    array = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    )
    return array, np.diff(np.searchsorted(starts, ends))


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number per word, to spread words evenly: a polynomial of its bytes, mixed."""
    parts = [_hashes(words.slice(at, _AT_ONCE)) for at in range(0, len(words), _AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _hashes(words: pa.Array) -> np.ndarray:
    data, ends = bytes_of(words)
    powers = np.cumprod(np.full(len(data) + 1, FACTOR, np.uint64))
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(powers[:-1] * (data.astype(np.uint64) + np.uint64(1)))))
    back = np.cumprod(np.full(len(data) + 1, pow(FACTOR, -1, 1 << 64), np.uint64))
    value = (before[ends[1:]] - before[ends[:-1]]) * back[ends[:-1]]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ value >> np.uint64(29)
