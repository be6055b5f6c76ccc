"""NumPy helpers over the bytes of Arrow text columns: pieces, words, rolling hashes.

Everything works on one piece of a batch at a time, so that the scratch arrays
of a task are bounded by ``PIECE`` plus the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes of text handled at once; scratch arrays of quality take some 60 times as much
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240607)
BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the hash base and of its inverse modulo 2**64."""
    for i, base in enumerate((BASE, BASE_INVERSE)):
        if len(_powers[i]) < n:
            full = np.full(max(n, PIECE + 1), np.uint64(base))
            full[0] = 1
            _powers[i] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PIECE`` bytes of text, and at most ``rows`` rows, each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < len(lengths):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        last = min(last, first + rows) if rows else last
        yield batch.slice(first, last - first)
        first = last


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with ``span_hash(S, i, j)`` the hash of bytes i..j-1."""
    power, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * power, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start])


def word_spans(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each row.

    ``is_word`` has one flag per byte value. Words never cross rows.
    """
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(begins[:n])
    ends_at = inside[:n] & (~inside[1:] | first[1:])
    ends = np.flatnonzero(ends_at) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), starts, ends)


def membership(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in ``sorted_keys``, -1 where it is absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def key_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where the keys of each slot begin; there are one to two slots for each key, of equal width between first and last key."""
    if not len(sorted_keys):
        return np.zeros(1, np.int32)
    slot = (sorted_keys - sorted_keys[0]) >> _slot_shift(sorted_keys)
    return np.searchsorted(slot, np.arange(int(slot[-1]) + 2, dtype=np.uint64)).astype(np.int32)


def _slot_shift(sorted_keys: np.ndarray) -> np.uint64:
    return np.uint64(max(0, int(sorted_keys[-1] - sorted_keys[0]).bit_length() - len(sorted_keys).bit_length()))


def membership_from(starts: np.ndarray, sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """As ``membership``, for hashes that are spread evenly: each search begins at its slot."""
    out = np.full(len(keys), -1, np.int64)
    if not len(sorted_keys):
        return out
    spot = np.flatnonzero((keys >= sorted_keys[0]) & (keys <= sorted_keys[-1]))
    wanted = keys[spot]
    at = starts[((wanted - sorted_keys[0]) >> _slot_shift(sorted_keys)).astype(np.int64)].astype(np.int64)
    there = sorted_keys[at]
    live = np.flatnonzero(there < wanted)
    while len(live):  # ends at the last key at the latest
        at[live] += 1
        there[live] = sorted_keys[at[live]]
        live = live[there[live] < wanted[live]]
    out[spot] = np.where(there == wanted, at, -1)
    return out


SPACE = np.ones(256, bool)  # words [^\x20\x09-\x0D]+
SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
