"""Words of many texts at once, as arrays over the bytes of an Arrow column.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``; all of these are ASCII, so words can be
cut on UTF-8 bytes. Word hashes are 64-bit polynomial hashes over random byte values, taken
as differences of prefix sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 19

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_RANDOM = np.random.default_rng(20_240_607)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[ord("A") : ord("Z") + 1] = BYTE_VALUES[ord("a") : ord("z") + 1]
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        row = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        row[0] = 1
        _powers[base] = np.multiply.accumulate(row)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hashes of any ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])
        self.back = powers(INVERSE, len(values) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


@dataclass
class Words:
    """Words of the rows of one slice: row of each word, byte range, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    #: First word of each row, and one entry more.
    first: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows) of a text column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that stay in their row: (row, start, end)."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    new_row = np.zeros(n + 1, dtype=bool)
    new_row[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | new_row[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | new_row[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def words_of(column: pa.Array, fold: bool = False) -> Words:
    """The words of every row; ``fold`` hashes A-Z as a-z."""
    data, offsets = buffers(column)
    row, start, end = runs(~SPACE[data], offsets)
    prefix = Prefix((FOLDED_VALUES if fold else BYTE_VALUES)[data])
    first = np.searchsorted(row, np.arange(len(offsets)))
    return Words(row, start, end, prefix.hash(start, end), data, first)


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)


def ragged(rows: np.ndarray, n: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: ``values`` belong to ``rows`` (ascending), of ``n`` rows."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
