"""Suffix sorting and an FM-index over integer sequences, vectorised with NumPy."""

from __future__ import annotations

import numpy as np


def _packed_sort(high: np.ndarray, low: np.ndarray, index: np.ndarray, bits: tuple[int, int, int]) -> np.ndarray:
    """The order of ``index`` by (high, low); one sort of packed numbers where they fit 64 bits."""
    if sum(bits) <= 64:
        packed = (high.astype(np.uint64) << np.uint64(bits[1] + bits[2])) | (low.astype(np.uint64) << np.uint64(bits[2])) | np.arange(len(index), dtype=np.uint64)
        packed.sort()
        return (packed & np.uint64((1 << bits[2]) - 1)).astype(np.int64)
    return np.lexsort((low, high))


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Start positions of all suffixes of ``s`` (symbols 0 to sigma - 1) in order; the end sorts below any symbol.

    Prefix doubling that only goes on with the suffixes whose order is not yet settled.
    """
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    width, nb = max(1, int(sigma).bit_length()), max(1, n.bit_length())
    h = max(1, (64 - nb) // width)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(h):  # the first h symbols at once, the end as 0 and symbols from 1
        part = np.zeros(n, dtype=np.uint64)
        part[: max(0, n - k)] = s[k:].astype(np.uint64) + np.uint64(1)
        key = (key << np.uint64(width)) | part
    sa = _packed_sort(np.zeros(n, np.uint8), key, key, (0, h * width, nb))
    ordered = key[sa]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    slots = np.arange(n, dtype=np.int64)
    group = np.maximum.accumulate(np.where(new, slots, 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = group
    while True:
        single = new & np.concatenate([new[1:], [True]])
        slots = slots[~single]
        if not len(slots):
            return sa
        active = sa[slots]
        after = active + h
        low = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        high = rank[active]
        order = _packed_sort(high, low, active, (nb, nb + 1, max(1, len(active).bit_length())))
        sa[slots] = active[order]
        high, low = high[order], low[order]
        new = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        rank[sa[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        h *= 2


class _Bits:
    """A bit vector with constant-time counts of ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])[:-1]

    def rank(self, i: np.ndarray) -> np.ndarray:
        w, b = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << b) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Counts of any symbol before any position of a sequence, by one bit vector for each bit of a symbol."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.depth = max(1, int(max(1, sigma - 1)).bit_length())
        self.levels, self.zeros = [], []
        for k in range(self.depth - 1, -1, -1):
            bit = (s >> k) & 1 != 0
            self.levels.append(_Bits(bit))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])
        self.base = self._walk(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for j, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (c >> (self.depth - 1 - j)) & 1 != 0
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``c`` before position ``i``."""
        return self._walk(c, i) - self.base[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its occurrences before it."""
        c = np.zeros(len(i), dtype=np.int64)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            one, r = bits.get(i), bits.rank(i)
            c = c * 2 + one
            i = np.where(one, zeros + r, i - r)
        return c, i - self.base[c]


class FMIndex:
    """Backward search and location over a sequence; symbol 0 separates and is never searched for."""

    def __init__(self, s: np.ndarray, sigma: int, sample: int = 16):
        sa = suffix_array(s, sigma)
        # one row more than suffixes: the empty suffix comes first and is preceded by the last symbol
        rows = np.concatenate([[len(s)], sa])
        before = np.where(rows > 0, s[np.maximum(rows - 1, 0)] + 1, 0)  # 0 marks the row of the whole sequence
        self.wavelet = WaveletMatrix(before.astype(np.int64), sigma + 1)
        counts = np.bincount(s, minlength=sigma)
        self.first = np.concatenate([[0, 1], 1 + np.cumsum(counts)])  # of symbol + 1
        self.size = len(rows)
        marked = rows % sample == 0
        self.marked, self.samples = _Bits(marked), rows[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of patterns (one in each row, of equal length)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, j].astype(np.int64) + 1
            low[alive] = self.first[c] + self.wavelet.rank(c, low[alive])
            high[alive] = self.first[c] + self.wavelet.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the nearest sampled suffix."""
        out, steps = np.zeros(len(rows), np.int64), 0
        waiting, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(waiting):
            hit = self.marked.get(at)
            out[waiting[hit]] = self.samples[self.marked.rank(at[hit])] + steps
            waiting, at = waiting[~hit], at[~hit]
            if len(waiting):
                c, before = self.wavelet.access(at)
                at = self.first[c] + before
                steps += 1
        return out
