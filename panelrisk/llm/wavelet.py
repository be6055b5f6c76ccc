"""Wavelet matrix over bit vectors, and the order of the rotations of a text."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits with the number of ones before every word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.uint32)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of every place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols 0..size-1, for many places at once, in one bit vector per binary digit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.size = size
        self.depth = max(1, int(size - 1).bit_length())
        self.levels, self.zeros = [], []
        rest = symbols
        for digit in range(self.depth - 1, -1, -1):
            ones = (rest >> digit) & 1 == 1
            self.levels.append(BitRank(ones))
            self.zeros.append(len(rest) - int(np.count_nonzero(ones)))
            rest = np.concatenate([rest[~ones], rest[ones]])
        every = np.arange(size)
        self.first = self._down(every, np.zeros(size, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = level.ones(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` stands in front of place ``i``."""
        return self._down(c, i) - self.first[c]

    def range(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks of ``c`` at both ends, and how many smaller symbols lie between them."""
        smaller = np.zeros(len(c), np.int64)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            up = (c >> (self.depth - 1 - k)) & 1 == 1
            a, b = level.ones(lo), level.ones(hi)
            smaller += np.where(up, (hi - b) - (lo - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return lo - self.first[c], hi - self.first[c], smaller

    def symbols(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols between the ends: asked row, symbol, ranks at both ends, smaller symbols between."""
        row, c = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        smaller = np.zeros(len(lo), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            a, b = level.ones(lo), level.ones(hi)
            low = (lo - a, hi - b)
            high = (zeros + a, zeros + b)
            row = np.concatenate([row, row])
            smaller = np.concatenate([smaller, smaller + low[1] - low[0]])
            c = np.concatenate([2 * c, 2 * c + 1])
            lo, hi = np.concatenate([low[0], high[0]]), np.concatenate([low[1], high[1]])
            there = hi > lo
            row, c, lo, hi, smaller = row[there], c[there], lo[there], hi[there], smaller[there]
        return row, c, lo - self.first[c], hi - self.first[c], smaller


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Places of a text in the order of the rotations that begin there, by doubled prefixes."""
    n, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1) + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        step *= 2
        if new.all() or step >= n:
            return order
