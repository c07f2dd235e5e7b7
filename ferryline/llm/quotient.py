"""Counting quotient filters that lose nothing: exact counters of packed n-grams of word ids.

An n-gram of up to four ids of ``bits`` bits is a pair of halves, two ids each (0: none). A Feistel
network permutes the pairs, so every key has one place and comes back from it. The leading
bits of a permuted key name its filter (``prefix``), the next ones are its quotient, and all the
rest is kept as the remainder: equal slots mean equal n-grams. A filter is sorted, so
filters of one prefix merge by order, and one filter splits into those of longer prefixes.

Stored form: a bitmap of the quotients that occur, a bitmap that marks the last entry of each
quotient's run, the remainders in as few bytes as their bits need, and a byte for each counter
with the large ones apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ferryline.llm.words import mix64

ORDER = 4  #: the longest n-gram
ROUNDS = [np.uint64(r * 0x9E3779B97F4A7C15 & (2**64 - 1)) for r in (1, 2, 3, 4)]
HEADER = 5 * 8  #: bytes before the bitmaps
LARGE = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permute(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for salt in ROUNDS:
        high, low = low, high ^ (mix64(low + salt) & _mask(half))
    return high, low


def restore(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for salt in reversed(ROUNDS):
        high, low = low ^ (mix64(high + salt) & _mask(half)), high
    return high, low


def ngrams(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys of all n-grams of 2 to ``ORDER`` ids without a 0."""
    ids = ids.astype(np.uint64)
    size, shift, highs, lows = len(ids), np.uint64(bits), [], []
    there = ids > 0
    pairs = (ids[:-1] << shift) | ids[1:]
    good = there.copy()
    for n in range(2, ORDER + 1):
        if size < n:
            break
        good = good[:size - n + 1] & there[n - 1:]
        at = np.flatnonzero(good)
        highs.append(pairs[at])
        lows.append(np.zeros(len(at), np.uint64) if n == 2 else
                    ids[at + 2] << shift if n == 3 else pairs[at + 2])
    if not highs:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return permute(np.concatenate(highs), np.concatenate(lows), 2 * bits)


def ids_of(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """The ids of permuted keys, one row of ``ORDER`` each."""
    high, low = restore(high, low, 2 * bits)
    mask, shift = _mask(bits), np.uint64(bits)
    return np.stack([high >> shift, high & mask, low >> shift, low & mask], axis=1).astype(np.int64)


@dataclass
class QuotientFilter:
    """Sorted distinct keys of one prefix, without it, and how often each occurs."""

    half: int
    prefix_bits: int
    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray, half: int, prefix_bits: int,
           counts: np.ndarray | None = None) -> QuotientFilter:
        """A filter of keys in any order, repeated ones included; the prefix is cut off already."""
        rest = half - prefix_bits
        if rest + half <= 64 and half < 64:
            packed = (high << np.uint64(half)) | low
            if counts is None:
                packed.sort()
            else:
                order = np.argsort(packed, kind="stable")
                packed, counts = packed[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else (
                np.zeros(0, np.int64))
            kept = packed[first]
            high, low = kept >> np.uint64(half), kept & _mask(half)
            size = len(packed)
        else:
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            counts = None if counts is None else counts[order]
            size = len(high)
            first = np.flatnonzero(np.concatenate(
                [[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if size else np.zeros(0, np.int64)
            high, low = high[first], low[first]
        if counts is None:
            total = np.diff(np.append(first, size))
        else:
            total = np.add.reduceat(counts, first) if size else np.zeros(0, np.int64)
        return cls(half, prefix_bits, high, low, total.astype(np.int64))

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter of filters with the same prefix; their sorted runs are merged."""
        first = filters[0]
        return cls.of(*(np.concatenate([getattr(f, x) for f in filters]) for x in ("high", "low")),
                      first.half, first.prefix_bits, np.concatenate([f.counts for f in filters]))

    def split(self, bits: int) -> list[tuple[int, QuotientFilter]]:
        """Filters of prefixes that are ``bits`` longer, with those bits; empty ones are left out."""
        rest = self.half - self.prefix_bits - bits
        heads = self.high >> np.uint64(rest)
        cuts = np.flatnonzero(np.diff(heads, prepend=heads[:1] + np.uint64(1), append=heads[-1:] + np.uint64(1)))
        return [(int(heads[a]), QuotientFilter(
            self.half, self.prefix_bits + bits, self.high[a:b] & _mask(rest), self.low[a:b], self.counts[a:b]))
            for a, b in zip(cuts[:-1], cuts[1:])]

    def to_bytes(self) -> bytes:
        size, rest = len(self.high), self.half - self.prefix_bits
        q = min(rest, max(0, size.bit_length() - 1))
        quotient = self.high >> np.uint64(rest - q)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient.astype(np.int64)] = True
        ends = np.append(quotient[1:] != quotient[:-1], True) if size else np.zeros(0, bool)
        large = self.counts[self.counts >= LARGE]
        return b"".join([
            np.array([size, q, self.prefix_bits, self.half, len(large)], "<i8").tobytes(),
            np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
            _narrow(self.high & _mask(rest - q), rest - q), _narrow(self.low, self.half),
            np.minimum(self.counts, LARGE).astype(np.uint8).tobytes(), large.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, stored: bytes) -> QuotientFilter:
        size, q, prefix_bits, half, n_large = np.frombuffer(stored, "<i8", HEADER // 8).tolist()
        data, at, rest = np.frombuffer(stored, np.uint8), HEADER, half - prefix_bits

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return data[at - n:at]

        occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
        ends = np.unpackbits(take(-(-size // 8)), count=size).astype(np.int64)
        quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
        high = _widened(take(size * _bytes(rest - q)), size) | (quotient << np.uint64(rest - q))
        low = _widened(take(size * _bytes(half)), size)
        counts = take(size).astype(np.int64)
        counts[counts == LARGE] = np.frombuffer(take(8 * n_large).tobytes(), "<i8")
        return cls(half, prefix_bits, high, low, counts)


def _bytes(bits: int) -> int:
    return -(-bits // 8)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(
        values.astype("<u8").view(np.uint8).reshape(len(values), 8)[:, :_bytes(bits)]).tobytes()


def _widened(stored: np.ndarray, size: int) -> np.ndarray:
    wide = np.zeros((size, 8), np.uint8)
    if size:
        wide[:, :len(stored) // size] = stored.reshape(size, -1)
    return wide.view("<u8").reshape(size).astype(np.uint64)


def filters_of(high: np.ndarray, low: np.ndarray, half: int, bits: int) -> list[tuple[int, QuotientFilter]]:
    """Filters of permuted keys by their first ``bits`` bits; each part is sorted by itself."""
    rest = half - bits
    heads = (high >> np.uint64(rest)).astype(np.uint16)
    order = np.argsort(heads, kind="stable")
    heads, high, low = heads[order], high[order] & _mask(rest), low[order]
    edges = np.flatnonzero(np.diff(heads.astype(np.int64), prepend=-1, append=-1))
    return [(int(heads[a]), QuotientFilter.of(high[a:b], low[a:b], half, bits))
            for a, b in zip(edges[:-1], edges[1:])]
