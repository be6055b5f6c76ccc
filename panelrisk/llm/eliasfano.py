"""Elias-Fano coded monotone sequences and an n-gram trie built from them."""

from __future__ import annotations

import json
import mmap
import os

import numpy as np

# place of the k-th set bit of each byte
_PLACE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], np.int64)


def _directory(high: np.ndarray) -> np.ndarray:
    """Ones before every word of 64 bits, as narrow as their number allows."""
    counts = np.cumsum(np.bitwise_count(high.view(np.uint64)), dtype=np.int64)
    kind = np.uint32 if not len(counts) or counts[-1] < 1 << 32 else np.int64
    return np.concatenate([[0], counts[:-1]]).astype(kind)


def _place_of(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Place of the one in each word of 64 bits that has ``left`` ones before it."""
    place = np.zeros(len(words), np.int64)
    for step in (32, 16, 8):
        ones = np.bitwise_count(words & np.uint64((1 << step) - 1)).astype(np.int64)
        over = left >= ones
        left = left - ones * over
        words = np.where(over, words >> np.uint64(step), words)
        place += over * step
    return place + _PLACE[(words & np.uint64(255)).astype(np.int64), left]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, read by rank and select."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.uint64)
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (top // max(self.n, 1)).bit_length() - 1)
        bits = np.empty((self.n, self.low_bits), np.uint8)
        for k in range(self.low_bits):
            bits[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        low = np.packbits(bits.ravel(), bitorder="little")
        self.low = np.concatenate([low, np.zeros(8 + -len(low) % 8, np.uint8)])
        high = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(self.n)
        unary = np.zeros(int(high[-1]) + 1 if self.n else 1, np.uint8)
        unary[high] = 1
        high = np.packbits(unary, bitorder="little")
        self.high = np.concatenate([high, np.zeros(-len(high) % 8, np.uint8)])
        self.ranks = _directory(self.high)

    def __getstate__(self):
        return {"n": self.n, "low_bits": self.low_bits, "low": self.low, "high": self.high}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ranks = _directory(self.high)

    def get(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ranks, at, "right") - 1
        left = at - self.ranks[word].astype(np.int64)  # ones to pass in the word
        place = (word << 6) + _place_of(self.high.view(np.uint64)[word], left)
        return (place - at).astype(np.uint64) << np.uint64(self.low_bits) | self._low(at)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit, words = at * self.low_bits, self.low.view(np.uint64)
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        # the bits that go on in the next word; two shifts, as one by 64 is not defined
        out = words[word] >> shift | words[word + 1] << np.uint64(1) << (np.uint64(63) - shift)
        return out & np.uint64((1 << self.low_bits) - 1)

    def find(self, value: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each value (between begin and end), -1 where it is absent."""
        found = np.full(len(value), -1, np.int64)
        if not self.n or not len(value):
            return found
        high = (value >> np.uint64(self.low_bits)).astype(np.int64)
        most = int(self.get(np.array([self.n - 1]))[0] >> np.uint64(self.low_bits))
        # values with the same high bits lie between two zeros of the unary bits
        zeros = (np.arange(len(self.ranks)) << 6) - self.ranks
        low, stop = np.zeros(len(value), np.int64), np.full(len(value), self.n)
        for out, zero in ((low, high - 1), (stop, high)):
            spot = np.flatnonzero((zero >= 0) & (zero < most))
            zero = zero[spot]
            word = np.searchsorted(zeros, zero, "right") - 1
            out[spot] = (word << 6) + _place_of(~self.high.view(np.uint64)[word], zero - zeros[word]) - zero
        low[high > most] = self.n
        low = low if begin is None else np.maximum(low, begin)
        stop = stop if end is None else np.minimum(stop, end)
        top, rest = stop.copy(), value & np.uint64((1 << self.low_bits) - 1)
        while True:
            live = np.flatnonzero(low < stop)
            if not len(live):
                break
            middle = (low[live] + stop[live]) >> 1
            less = self._low(middle) < rest[live]
            low[live] = np.where(less, middle + 1, low[live])
            stop[live] = np.where(less, stop[live], middle)
        spot = np.flatnonzero(low < top)
        equal = self._low(low[spot]) == rest[spot]
        found[spot[equal]] = low[spot[equal]]
        return found


class Quantised:
    """Numbers as one byte each with a table of 256 means."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.float64)
        if not len(values):
            self.table, self.codes = np.zeros(1), np.zeros(0, np.uint8)
            return
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, 257)[1:-1]))
        codes = np.searchsorted(cuts, values, "left")
        count = np.maximum(np.bincount(codes, minlength=len(cuts) + 1), 1)
        self.table = np.bincount(codes, values, len(cuts) + 1) / count
        self.codes = codes.astype(np.uint8)

    def get(self, at: np.ndarray) -> np.ndarray:
        return self.table[self.codes[at]]


class NgramTrie:
    """Bigrams and trigrams over word numbers, with log10 probabilities and backoff weights.

    Level two holds the followers of each word. Level three holds the followers of
    each bigram, not as word numbers but as places among the followers of its last
    word (a kept trigram has a kept last bigram), which are small numbers.
    """

    def __init__(self, words: int, pairs: np.ndarray, pair_p: np.ndarray, word_back: np.ndarray,
                 triples: np.ndarray, triple_p: np.ndarray, pair_back: np.ndarray):
        """``pairs`` (n, 2) and ``triples`` (m, 3) are word numbers in lexicographic order."""
        self.words = words
        first = np.searchsorted(pairs[:, 0], np.arange(words + 1)) if len(pairs) else np.zeros(words + 1, np.int64)
        self.begin = EliasFano(first)
        self.follow = EliasFano(pairs[:, 0].astype(np.uint64) * np.uint64(words) + pairs[:, 1].astype(np.uint64))
        self.pair_p, self.word_back = Quantised(pair_p), Quantised(word_back)
        code = pairs[:, 0] * words + pairs[:, 1]
        context = np.searchsorted(code, triples[:, 0] * words + triples[:, 1])
        last = np.searchsorted(code, triples[:, 1] * words + triples[:, 2])
        self.span = int(np.diff(first).max(initial=0)) + 1
        relative = last - first[triples[:, 1]]
        self.third = EliasFano(context.astype(np.uint64) * np.uint64(self.span) + relative.astype(np.uint64))
        self.triple_p, self.pair_back = Quantised(triple_p), Quantised(pair_back)

    def pair(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.follow.find(u.astype(np.uint64) * np.uint64(self.words) + v.astype(np.uint64))

    def triple(self, context: np.ndarray, v: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Trigram of a bigram place and the place of its last bigram (v, w)."""
        relative = last - self.begin.get(v).astype(np.int64)
        return self.third.find(context.astype(np.uint64) * np.uint64(self.span) + relative.astype(np.uint64))

    def save(self, path: str) -> None:
        """All levels one after the other in one file of a folder, to be mapped into memory."""
        os.makedirs(path, exist_ok=True)
        arrays = {}
        for name, value in self.__dict__.items():
            parts = value.__dict__ if hasattr(value, "__dict__") else {"value": value}
            for part, v in parts.items():
                arrays[f"{name}.{part}"] = np.asarray(v)
        write_arrays(f"{path}/levels", arrays)

    @classmethod
    def load(cls, path: str) -> NgramTrie:
        """The trie with its arrays mapped from the file; pages are read where a search touches them."""
        arrays = map_arrays(f"{path}/levels")
        out = cls.__new__(cls)
        for name, v in arrays.items():
            name, part = name.split(".")
            if part == "value":
                setattr(out, name, int(v))
                continue
            if name not in out.__dict__:
                kind = EliasFano if f"{name}.high" in arrays else Quantised
                setattr(out, name, kind.__new__(kind))
            getattr(out, name).__dict__[part] = int(v) if part in ("n", "low_bits") else v
        return out


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A line with names, types, shapes and places, and the arrays, each at a multiple of 8 bytes."""
    head, at = {}, 0
    for name, v in arrays.items():
        head[name] = [v.dtype.str, list(v.shape), at]
        at += -(-v.nbytes // 8) * 8
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    with open(path, "wb") as file:
        file.write(line)
        for v in arrays.values():
            file.write(v.tobytes())
            file.write(bytes(-v.nbytes % 8))


def map_arrays(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as file:
        line = file.readline()
        held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    out = {}
    for name, (kind, shape, at) in json.loads(line).items():
        size = int(np.prod(shape, dtype=np.int64))
        out[name] = np.frombuffer(held, kind, size, len(line) + at).reshape(shape) if size else np.zeros(shape, kind)
    return out
