"""Words of whole texts, hashed a slice of bytes at a time.

A word is a maximal run of digits, letters a-z (A-Z is lower-cased) and
characters beyond ASCII. In UTF-8 that is a test of single bytes, so a slice of
a column is cut and hashed with array operations, without a Python loop over
words. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; arrays take about 60 times as much.
SLICE_BYTES = 2_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[65:91] = True
    inside[128:] = True
    values = np.random.default_rng(20240521).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
    return lower, inside, values[lower]


LOWER, INSIDE, _VALUE = _byte_tables()
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n, kept by the process."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for at, factor in enumerate((_BASE, _INVERSE)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _powers[at] = np.multiply.accumulate(table)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal runs get equal hashes."""
    power, inverse = _power_tables(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * power[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def range_hash_without(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, left_out: np.ndarray) -> np.ndarray:
    """The hash that values[start:end] would have without the element at `left_out`."""
    power, inverse = _power_tables(len(values) + 1)
    total = np.r_[_U(0), np.cumsum(values * power[:len(values)])]
    before = (total[left_out] - total[starts]) * inverse[starts]
    after = (total[ends] - total[left_out + 1]) * inverse[left_out + 1]
    return mix(before + after * power[left_out - starts] + (ends - starts - 1).astype(np.uint64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the place where each row starts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)
    offsets = offsets[column.offset:]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about `limit` bytes; a longer text is alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


class Words:
    """Words of a slice: byte range and hash of each, and the first word of each row."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = column_bytes(column)
        inside = INSIDE[self.raw]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(self.raw))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """The row each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return range_hash(_VALUE[self.raw], self.starts, self.ends)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all runs of k words that lie within one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        rolled = rolled * _U(_BASE) + hashes[j:n + j]
    whole = np.ones(len(hashes), bool)
    for j in range(1, k):
        at = first[1:] - j
        whole[at[(at >= 0)]] = False
    places = np.flatnonzero(whole[:n])
    return places, mix(rolled[places])


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of k words; a row of fewer, but not none, has one of them all."""
    places, values = windows(hashes, first, k)
    counts = np.diff(first)
    rows = np.searchsorted(first, places, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = range_hash(hashes, first[short], first[short + 1])
        rows, values = np.r_[rows, short], np.r_[values, extra]
    return rows, values


def per_slice(column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch],
              limit: int = SLICE_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives `work` a slice of each batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                yield work(part)
            pa.default_memory_pool().release_unused()  # workers are used again
    return run


def list_column(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Rows of values[first[i]:first[i+1]]."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))
