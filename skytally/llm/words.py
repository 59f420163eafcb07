"""Words of whole Arrow columns as numpy arrays: where they are and a 64-bit key of each.

Work goes over slices of a few megabytes of text, so memory does not depend on how many rows a batch has. A
single text longer than a slice is one slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))

# Odd constants of the 64-bit finaliser known from splitmix64.
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each with at most ``most`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in a row, and where each begins (one more offset at the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    begins = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


@dataclass
class Words:
    """All words of a slice, in order."""

    rows: int
    data: np.ndarray  # the flat bytes, A-Z in lower case if asked for
    row: np.ndarray  # of each word
    start: np.ndarray  # in the flat bytes
    end: np.ndarray
    key: np.ndarray  # 64-bit, equal for equal words

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def place(self) -> np.ndarray:
        """Position of each word in its text, from 0."""
        first = np.concatenate(([0], np.cumsum(self.counts())[:-1]))
        return np.arange(len(self.row)) - first[self.row]


def words(column: pa.Array, kept: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """Maximal runs of the bytes marked in ``kept``; A-Z count as a-z if ``lower``."""
    data, offsets = flat(column)
    rows, size = len(column), len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(rows, data, none, none, none, none.astype(np.uint64))
    if lower:
        data = LOWER[data]
    inside = kept[data]
    cut = np.zeros(size + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:size]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:size]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(rows, data, row, start, end, keys(data, start, end))


def keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of byte ranges, eight bytes at a step."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    key = length.astype(np.uint64) * _STEP
    left = np.arange(len(start))
    done = 0
    while len(left):
        rest = length[left] - done
        part = eight[start[left] + done]
        short = np.minimum(rest, 8).astype(np.uint64)
        part = part & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - short) * np.uint64(8)))
        key[left] = mixed(key[left] + _STEP ^ part)
        left = left[rest > 8]
        done += 8
    return key


def grams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and key of every run of ``n`` words within one text."""
    size = len(found.key) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(found.row[:size] == found.row[n - 1 :])
    key = found.key[first]
    for k in range(1, n):
        key = mixed(key * _STEP + found.key[first + k])
    return first, key
