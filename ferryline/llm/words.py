"""Words of whole Arrow batches as numpy arrays, without a Python loop over words.

Words are runs of bytes other than 0x20 and 0x09-0x0D. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers; their values only need to be the same everywhere.
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a batch: ``row`` (0..n-1), byte range in ``data`` and a hash of each."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  #: of each row its first word, and the number of words at the end


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset or column.buffers()[2] is None:
        column = pa.concat_arrays([column, pa.array([""], pa.large_string())]).slice(0, len(column))
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    base = offsets[0]
    return data[base:offsets[-1]], offsets - base


def words_of(column: pa.Array) -> Words:
    data, offsets = text_buffers(column)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    return Words(data, start, end, row, _hashes(data, start, end), first)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    total = int(size.sum())
    to = np.cumsum(size)
    inner = np.arange(total) - np.repeat(to - size, size)
    letters = data[np.repeat(start, size) + inner].astype(np.uint64) + np.uint64(1)
    longest = int(size.max())
    letters *= powers(_BYTE_BASE, longest)[inner]
    return mix64(np.add.reduceat(letters, to - size) + size.astype(np.uint64))


def runs_of_hashes(values: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """A hash of ``length`` values from each place that has so many after it."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * base + values[k:k + n]
    return mix64(out)


def slices(column_lengths: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges whose lengths add up to about ``limit``; a longer row is alone."""
    cut, out, begin = 0, [], 0
    for i, size in enumerate(column_lengths.tolist()):
        if cut and cut + size > limit:
            out.append((begin, i))
            begin, cut = i, 0
        cut += size
    if begin < len(column_lengths):
        out.append((begin, len(column_lengths)))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column of consecutive runs of ``values``."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
