"""Text columns as byte arrays: hashes of windows and words for whole Arrow batches.

All functions are pure and keep about forty bytes per byte of text, so callers hand
them pieces of bounded size (``pieces``). A single text longer than the bound is a
piece of its own; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
MASK = (1 << 64) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTES = np.random.default_rng(20_240_101).integers(1, MASK, 256, dtype=np.uint64) | np.uint64(1)
# The bytes that end a word: space and tab, line feed, vertical tab, form feed, return.
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more entry at the end). Null is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, ends, data = texts.buffers()
    starts = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def small(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def pieces(starts: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes together."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, size: int) -> np.ndarray:
    """base**0 ... base**(size-1), modulo 2**64."""
    rounded = 1 << max(16, int(size - 1).bit_length())
    if rounded > 4 * PIECE:
        out = np.full(size, base, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)
    return _powers(base, rounded)[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """Finish a hash: every bit of the input reaches every bit of the output."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_MULTIPLIER, len(data)), out=out[1:])
    return out


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` bytes."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    sums = _sums(data)
    return mixed((sums[width:] - sums[:-width]) * powers(_INVERSE, len(sums) - width))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each whitespace-delimited word, and how many words each text has."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    before = solid[:-1].copy()  # before[i]: whether byte i - 1 belongs to a word of the same text
    before[starts] = 0
    begins = np.flatnonzero((solid[1:] == 1) & (before == 0))
    after = solid[1:].copy()
    after[starts] = 0
    ends = np.flatnonzero((solid[:-1] == 1) & (after == 0))
    cuts = np.searchsorted(begins, starts)
    return begins, ends, np.diff(cuts)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = _sums(data)
    inverse = powers(_INVERSE, len(data) + 1)
    return mixed((sums[ends] - sums[begins]) * inverse[begins])


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``size`` words, and where each text's begin.

    A text of fewer words has one shingle of all its words, an empty one none.
    """
    first = np.concatenate([[0], np.cumsum(counts)])
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(made)])
    total = int(starts[-1])
    row = np.repeat(np.arange(len(counts)), made)
    at = first[row] + (np.arange(total) - starts[row])
    out = np.zeros(total, np.uint64)
    left = first[row + 1] - at
    for step in range(size):
        inside = left > step
        value = hashes[np.minimum(at + step, max(len(hashes) - 1, 0))] if len(hashes) else out
        out = np.where(inside, out * np.uint64(_MULTIPLIER) + value, out * np.uint64(3))
    return mixed(out), starts


def sliding(values: np.ndarray, width: int, reduce) -> np.ndarray:
    """``reduce`` (np.minimum or np.maximum) over each run of ``width`` values."""
    out, size = values, 1
    while size * 2 <= width:
        out = reduce(out[:-size], out[size:])
        size *= 2
    if size < width:
        rest = width - size
        out = reduce(out[:-rest], out[rest:])
    return out
