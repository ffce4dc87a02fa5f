"""Helpers shared by the corpus operators: reading, staging, and words of UTF-8 batches in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wardlight.workspace import stage

__all__ = ["read", "stage", "slices", "utf8", "lower_ascii", "word_table", "words", "Prefix", "mix", "spread"]

SLICE_BYTES = 1 << 20
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a string column in runs of about `size` bytes: their bytes, and each row's first byte and the end.

    A run holds whole rows, at least one, so memory follows the longest text and not the batch. NULL is an empty text.
    """
    data, offsets = utf8(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes stay."""
    return _LOWER[data]


def word_table(separators: bytes) -> np.ndarray:
    """For each byte, whether it belongs to a word. Bytes of characters beyond ASCII always do."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, in order. Words never run across rows."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


class Prefix:
    """64-bit hashes of any byte ranges of a buffer, from one running sum of a polynomial."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _power_table(_INVERSE, len(data) + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        plain = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(plain ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spread(rows: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    """How often each of n rows occurs, or the sum of its values."""
    return np.bincount(rows, values, minlength=n).astype(np.int64)
