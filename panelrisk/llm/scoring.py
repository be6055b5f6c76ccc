"""Log probability of texts under a word trigram model in an Elias-Fano trie.

Counts cover all training documents. The model interpolates trigrams, bigrams and
an add-half unigram estimate with absolute discounting. It holds every n-gram that
occurs ``LEAST`` times, whatever the size of the corpus, and so grows with it.

Every occurrence of a word with its neighbours goes once, packed, to the part of
that word; a part has about ``PART`` of them. There the training occurrences are
counted, the levels of the part are written to the shared folder and mapped, and
the distinct n-grams of all texts are looked up; then its levels go. What they add returns as one sum
per text and part. A word with more occurrences is dealt over several parts; each
asks for the counts of the bigrams that it has, and of no others. Words of the
n-grams are looked up with their counts in mapped files, rarer ones that have a share
of ``HEAD`` (at most 1/``HEAD``) are broadcast; the occurrences of all others are
joined with the table of counts.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B
from panelrisk.llm.eliasfano import NgramTrie, map_arrays, write_arrays
from panelrisk.llm.scratch import Scratch

HEAD = 2.0 ** -20   # share of tokens from which a word is looked up in memory
LEAST = 2.0         # occurrences from which a word, bigram or trigram is kept, at every size
KEEP = 0.0          # share of tokens that it must have besides; not used unless asked for
PART = 500_000      # tokens whose n-grams make one part
DISCOUNT = 0.75
FLUSH = 4_000_000   # tokens counted together in a task
GRAMS = 500_000     # n-grams that a task packs together, and rows at most
_SPOT = 22          # bits of a row's place among those packed together
END = np.uint64(0x0DDC0FFEE0DDF00D)
CONTEXT, FOLLOWER = -1, -2  # roles of a bigram in a part
_SUMS = pa.struct([("word", pa.int64()), ("share", pa.float64())])
_BITS = 31          # bits of a word number in a packed bigram
_MASK = (1 << _BITS) - 1


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and one end per text, and the row of each token."""
    data, offsets = B.flat_text(column)
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, offsets, B.SPACE)
    h = B.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    h[h == END] += np.uint64(1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first) + 1)
    return np.insert(h, first[1:], END), rows


class _Counter:
    """Occurrences of words, in training texts and in all, that are passed on now and then."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, words: np.ndarray, learned: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((words, learned))
        self.size += len(words)
        if self.size >= FLUSH:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        words, learned = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 2
        self.held, self.size = [], 0
        known, found = np.unique(words[learned.astype(bool)], return_counts=True)
        words, n = np.unique(words, return_counts=True)
        c = np.zeros(len(words), np.int64)
        c[np.searchsorted(words, known)] = found
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(c), pa.array(n)], names=["word", "c", "everywhere"])


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, everywhere) of (text, held_out): how often training texts, and all texts, have a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                words, row = tokens(piece.column("text"))
                yield from counter.add(words.view(np.int64), ~_flags(piece)[row])
        yield counter.flush()

    counts = docs.mapInArrow(run, "word long, c long, everywhere long")
    return counts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("everywhere").alias("everywhere"))


def _flags(piece: pa.RecordBatch) -> np.ndarray:
    return piece.column("held_out").to_numpy(zero_copy_only=False).astype(bool)


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers below 2^31, or single floats, compressed byte by byte of all values."""
    flat = np.stack([c.view(np.int32) if c.dtype == np.float32 else c.astype(np.int32) for c in columns])
    planes = flat.view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, columns: int, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=4 * columns * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 4, n).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view(np.int32)[:, :, 0]


class Vocabulary:
    """Words with the model's least count in hash order, in mapped files of one hash range each."""

    def __init__(self, files: list[tuple[int, str]]):
        self.first = np.concatenate([[0], np.cumsum([n for n, _ in files])]).astype(np.int64)
        self.paths, self.opened = [p for _, p in files], None

    def __getstate__(self):
        return {"first": self.first, "paths": self.paths, "opened": None}

    def _maps(self) -> list:
        if self.opened is None:
            self.opened = [map_arrays(p) for p in self.paths]
        return self.opened

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for a word that is not here."""
        out = np.full(len(h), -1, np.int64)
        if not self.paths:
            return out
        of = _range_of(h, len(self.paths))
        for k, part in enumerate(self._maps()):
            spot = np.flatnonzero(of == k) if len(self.paths) > 1 else np.arange(len(h))
            found = B.membership_from(part["first"], part["word"], h[spot])
            out[spot] = np.where(found >= 0, found + self.first[k], -1)
        return out

    def counts(self, number: np.ndarray) -> np.ndarray:
        out = np.zeros(len(number), np.int64)
        of = np.searchsorted(self.first, number, "right") - 1
        for k, part in enumerate(self._maps()):
            spot = np.flatnonzero(of == k)
            out[spot] = part["c"][number[spot] - self.first[k]]
        return out


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def store_vocabulary(table: DataFrame, least: float, size: int, folder: str) -> Vocabulary:
    """One file for each of the hash ranges; ``size`` words lie in a range on average."""
    often = table.where(F.col("c") >= least)
    ranges = max(1, -(-often.count() // size))
    place = F.shiftright(F.shiftrightunsigned("word", 32) * F.lit(ranges), 32).cast("int")

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        words = rows["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(words)
        path = f"{folder}/words-{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        words = words[order]
        write_arrays(path, {"word": words, "c": rows["c"].to_numpy(np.int64)[order], "first": B.key_starts(words)})
        return pd.DataFrame({"k": [int(rows["k"].iloc[0])], "n": [len(rows)], "path": [path]})

    made = often.withColumn("k", place).groupBy("k").applyInPandas(write, "k int, n long, path string").collect()
    files = {r["k"]: (r["n"], r["path"]) for r in made}  # one row for each range
    if len(files) == ranges:
        return Vocabulary([files[k] for k in range(ranges)])
    if not files:
        return Vocabulary([])
    empty = f"{folder}/words-none"
    os.makedirs(folder, exist_ok=True)
    write_arrays(empty, {"word": np.zeros(0, np.uint64), "c": np.zeros(0, np.int64), "first": np.zeros(1, np.int32)})
    return Vocabulary([files.get(k, (0, empty)) for k in range(ranges)])


def _distinct(pair: np.ndarray, last: np.ndarray) -> tuple:
    """Distinct rows in order, a place of each, and the number of each row's own."""
    order = np.argsort(pair)
    group = np.zeros(len(pair), np.int64)
    group[order[1:]] = np.cumsum(pair[order[1:]] != pair[order[:-1]])
    order = np.argsort(group << 32 | last + 1)  # last is -1 or below 2^31
    a, b = pair[order], last[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    back = np.empty(len(a), np.int64)
    back[order] = np.cumsum(new) - 1
    return a[first], b[first], order[first], back


@dataclass
class TrigramModel:
    head: np.ndarray         # hashes of words with a share of ``HEAD`` that are too rare for the vocabulary, sorted
    counts: np.ndarray       # their counts
    total: int               # N
    distinct: int            # V
    vocabulary: Vocabulary   # the words of n-grams
    parts: int
    spread: dict[int, int]   # over how many parts the n-grams around a very frequent word are dealt
    hot: np.ndarray          # hashes of these words, sorted
    least: float = LEAST
    folder: str = ""         # of the levels
    back: tuple = ((), ())   # very frequent words by number, and what their followers leave to the base

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def part_of(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Part of the n-grams with v in the middle and u (-1: none) before it."""
        at = B.mix(v.astype(np.uint64))
        for word, times in self.spread.items():  # at most ``parts`` words
            spot = np.flatnonzero(v == word)
            at[spot] += B.mix((u[spot] + 1).astype(np.uint64)) % np.uint64(times)
        return (at % np.uint64(self.parts)).astype(np.int64)


def _often(counts: DataFrame, column: str, least: float) -> pd.DataFrame:
    # at most one row per share: the shares of all rows sum to one
    return counts.where((F.col("c") > 0) & (F.col(column) >= least)).select("word", "c", "everywhere").toPandas()


def train(
    docs: DataFrame, scratch: Scratch, head: float = HEAD, keep: float = KEEP, part: int = PART
) -> tuple[TrigramModel, DataFrame]:
    """Words of the model for (text, held_out), and the table (word, c) of all training tokens."""
    table = scratch.write(count_words(docs), "words")
    n, everywhere, v = table.agg(F.sum("c"), F.sum("everywhere"), F.count_if(F.col("c") > 0)).first()
    n, everywhere = int(n or 0), int(everywhere or 0)
    least = max(LEAST, keep * n)
    often = _often(table.where(F.col("c") < least), "c", max(1.0, head * n))
    hashes = often["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], often["c"].to_numpy(np.int64)[order]
    folder = mounted(scratch.folder) + "/levels"
    vocabulary = store_vocabulary(table, least, 2 * part, folder)
    hot = _often(table, "everywhere", part)  # at most everywhere / part words
    words = hot["word"].to_numpy(np.int64).view(np.uint64)
    number = vocabulary.numbers(words)
    spread = {int(k): int(-(-c // part)) for k, c, w in zip(number, hot["everywhere"], words) if k >= 0 and w != END}
    dealt = np.sort(words[(number >= 0) & (words != END)])
    parts = max(1, -(-everywhere // part))
    return TrigramModel(hashes, counts, n, int(v), vocabulary, parts, spread, dealt, least, folder), table.where("c > 0")


def mounted(folder: str) -> str:
    """Path of the shared folder for open(); its files are mapped into memory."""
    if not (folder.startswith("file:") or "://" not in folder):
        raise ValueError("spark.checkpoint.dir must be a mounted folder: the levels of the model are mapped from it")
    return "/" + folder.removeprefix("file:").lstrip("/")


def _asked(held: list[tuple], model: TrigramModel) -> Iterator[pa.RecordBatch]:
    """Bigrams (v, w) with the part that has them and how often training texts have them there, by v and w."""
    code, part, learned = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64),) * 3
    code, part, _, back = _distinct(code, part)
    c = np.bincount(back, learned, len(code)).astype(np.int64)
    yield _dealt(model.part_of(code & _MASK, code >> _BITS), code >> _BITS, code & _MASK, part, c)


def _dealt(part: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for each part with its rows of the columns, packed."""
    order = np.argsort(part, kind="stable")
    spots = np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []
    made = [(int(part[s[0]]), -1, len(s), _pack(*(c[s] for c in columns))) for s in spots]
    rows = zip(*made) if made else ([],) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
        names=["part", "chunk", "n", "blob"])


def _hot_followers(source: DataFrame, model: TrigramModel, scratch: Scratch) -> DataFrame:
    """Training counts of the bigrams after very frequent words, for each part that has them in (text, held_out).

    No part gets more of them than it has occurrences. What the followers of a word
    leave to the base goes into ``model.back``.
    """
    shared = source.sparkSession.sparkContext.broadcast(model)
    schema = "part long, chunk long, n int, blob binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = shared.value, [], 0
        number = model.vocabulary.numbers(model.hot)
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                h, row = tokens(piece.column("text"))
                place = B.membership(model.hot, h[:-1])
                at = np.flatnonzero((place >= 0) & (row[1:] == row[:-1]))
                after = model.vocabulary.numbers(h[at + 1])
                at, after = at[after >= 0], after[after >= 0]
                before = np.where((at > 0) & (row[at - 1] == row[at]), model.vocabulary.numbers(h[at - 1]), -1)
                v = number[place[at]]
                held.append((v << _BITS | after, model.part_of(before, v), ~_flags(piece)[row[at]]))
                size += len(at)
                if size >= FLUSH:
                    yield from _asked(held, model)
                    held, size = [], 0
        yield from _asked(held, model)

    def answer(rows: pa.Table) -> pa.Table:
        model = shared.value
        v, w, part, c = np.concatenate([_unpack(b.as_py(), 4, n.as_py()) for b, n in zip(
            rows.column("blob"), rows.column("n"))], axis=1).astype(np.int64)
        code, part, _, back = _distinct(v << _BITS | w, part)
        bigram, of = np.unique(code, return_inverse=True)
        total = np.bincount(of, np.bincount(back, c, len(code)), len(bigram)).astype(np.int64)
        kept = total >= model.least
        word, at = np.unique(bigram[kept] >> _BITS, return_inverse=True)
        share = np.bincount(at, total[kept] - DISCOUNT, len(word))
        spot = np.flatnonzero(kept[of])
        code, total = code[spot], total[of[spot]]
        batch = _dealt(part[spot], code >> _BITS, code & _MASK, total >> _BITS, total & _MASK)
        sums = pa.array([{"word": int(a), "share": float(b)} for a, b in zip(word, share)], _SUMS)
        return pa.concat_tables([
            pa.Table.from_batches([batch]).append_column("sums", pa.nulls(len(batch), pa.list_(_SUMS))),
            pa.table([*(pa.nulls(1, f.type) for f in batch.schema), pa.ListArray.from_arrays([0, len(sums)], sums)],
                     names=[*batch.schema.names, "sums"])])

    asked = source.select("text", "held_out").mapInArrow(ask, schema)
    answers = scratch.write(asked.groupBy("part").applyInArrow(
        answer, schema + ", sums array<struct<word: long, share: double>>"), "followers")
    # one row for each very frequent word
    sums = answers.select(F.explode("sums").alias("s")).groupBy("s.word").agg(F.sum("s.share").alias("share")).collect()
    share = {r["word"]: r["share"] for r in sums}
    number = np.array(sorted(model.spread), np.int64)
    left = 1 - np.array([share.get(int(k), 0.0) for k in number]) / model.vocabulary.counts(number)
    model.back = (tuple(number.tolist()), tuple(np.clip(left, 1e-9, 1.0).tolist()))
    return answers.where("part is not null").drop("sums")


def _kept(code: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(code, return_inverse=True)
    c = np.bincount(at, n, len(code)).astype(np.int64)
    return code[c >= least], c[c >= least]


def look_up_part(rows: pd.DataFrame, model: TrigramModel) -> pd.DataFrame:
    """What the n-grams of one part add to the texts that have them, packed as (place of the row, sum) per chunk."""
    own = rows[rows["chunk"] >= 0]
    if not len(own):
        return pd.DataFrame({"chunk": [], "n": [], "blob": []})
    u, v, w, place = np.concatenate([_unpack(b, 4, n) for b, n in zip(own["blob"], own["n"])], axis=1).astype(np.int64)
    learned = place & 1 == 1
    # distinct n-grams, how often training texts have them, and their contexts
    pair, last, one, back = _distinct(v << _BITS | u + 1, w)
    n = np.bincount(back, learned, len(one)).astype(np.int64)
    u, v, w = (pair & _MASK) - 1, pair >> _BITS, last
    start = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    context, context_c = u[start] << _BITS | v[start], np.add.reduceat(n, start)
    kept = (u[start] >= 0) & (context_c >= model.least)
    context, context_c = context[kept], context_c[kept]
    dealt = np.isin(v, np.array(sorted(model.spread), np.int64))
    here = (n > 0) & (w >= 0) & ~dealt
    follow, follow_c = _kept(v[here] << _BITS | w[here], n[here], model.least)
    for b, size in zip(rows.loc[rows["chunk"] < 0, "blob"], rows.loc[rows["chunk"] < 0, "n"]):
        first, after, high, low = _unpack(b, 4, size).astype(np.int64)
        follow, follow_c = np.append(follow, first << _BITS | after), np.append(follow_c, high << _BITS | low)
    often = (u >= 0) & (w >= 0) & (n >= model.least)
    words, trie = _levels(
        model, np.concatenate([context, follow, u[often] << _BITS | v[often]]),
        np.concatenate([np.full(len(context), CONTEXT), np.full(len(follow), FOLLOWER), w[often]]),
        np.concatenate([context_c, follow_c, n[often]]), np.unique(v[dealt]))
    del context, follow, pair, last, one, often, learned, dealt, here, n
    path = f"{model.folder}/part-{uuid.uuid4().hex}"
    trie.save(path)
    write_arrays(f"{path}/words", {"words": words})
    del words, trie
    value, replaced = _looked_up(path, u, v, w)
    shutil.rmtree(path, True)  # all n-grams of the part are looked up
    # the base of the word is in the score already, or joined later
    value[replaced] -= model.base(model.vocabulary.counts(w[replaced]))
    row = np.repeat(np.arange(len(own)), own["n"]) << _SPOT | place >> 1
    row, at = np.unique(row, return_inverse=True)
    value = np.bincount(at, value[back], len(row)).astype(np.float32)
    cuts = np.searchsorted(row >> _SPOT, np.arange(len(own) + 1))
    return pd.DataFrame({
        "chunk": own["chunk"].to_numpy(), "n": np.diff(cuts),
        "blob": [_pack(row[a:b] & ((1 << _SPOT) - 1), value[a:b]) for a, b in zip(cuts, cuts[1:])]})


def add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums per row of one chunk over all parts."""
    total = np.zeros(1 << _SPOT)
    has = np.zeros(1 << _SPOT, bool)
    for b, n in zip(rows["blob"], rows["n"]):
        spot, value = _unpack(b, 2, n)
        total[spot] += np.ascontiguousarray(value).view(np.float32)  # a row is there once
        has[spot] = True
    spot = np.flatnonzero(has)
    return pd.DataFrame({"row": (int(rows["chunk"].iloc[0]) << _SPOT) + spot, "more": total[spot]})


def _levels(
    model: TrigramModel, pair: np.ndarray, last: np.ndarray, c: np.ndarray, dealt: np.ndarray
) -> tuple[np.ndarray, NgramTrie]:
    """Words of a part, sorted, and the trie over their places. Of words that are ``dealt``, some followers are elsewhere."""
    triple = last >= 0
    code, one = np.unique(pair[~triple], return_index=True)
    pair_c = c[~triple][one]
    whole = np.isin(code, pair[last == FOLLOWER])  # the others are contexts only
    words = np.unique(np.concatenate([code >> _BITS, code & _MASK, dealt]))
    u, v = np.searchsorted(words, code >> _BITS), np.searchsorted(words, code & _MASK)
    word_c = model.vocabulary.counts(words)
    base = 10.0 ** model.base(word_c)
    share = np.maximum(pair_c - DISCOUNT, 0) / word_c[u]
    back = np.clip(1 - np.bincount(u, np.where(whole, share, 0.0), len(words)), 1e-9, 1.0)
    if len(dealt):
        number, left = (np.array(x) for x in model.back)
        back[np.searchsorted(words, dealt)] = left[np.searchsorted(number, dealt)]
    pair_p = np.log10(share + back[u] * base[v])
    if whole.any():
        pair_p[~whole] = pair_p[whole].mean()  # never read
    order = np.lexsort((last[triple], pair[triple]))
    context, third, triple_c = pair[triple][order], last[triple][order], c[triple][order]
    at = np.searchsorted(code, context)
    end = np.searchsorted(code, (context & _MASK) << _BITS | third)
    share3 = np.maximum(triple_c - DISCOUNT, 0) / pair_c[at]
    back3 = np.clip(1 - np.bincount(at, share3, len(code)), 1e-9, 1.0)
    triple_p = np.log10(share3 + back3[at] * 10.0 ** pair_p[end])
    trie = NgramTrie(
        max(len(words), 1), np.column_stack([u, v]), pair_p, np.log10(back),
        np.column_stack([u[at], v[at], np.searchsorted(words, third)]), triple_p, np.log10(back3))
    return words, trie


def _once(find, *keys: np.ndarray) -> np.ndarray:
    """Places of keys, each distinct one searched once and in order."""
    code, one, back = np.unique(keys[0] << 40 | keys[1], return_index=True, return_inverse=True)
    return find(*(k[one] for k in keys))[back]


def _looked_up(path: str, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What n-grams of one part add to, or put in place of, the base of w; the part is mapped meanwhile only."""
    words, trie = map_arrays(f"{path}/words")["words"], NgramTrie.load(path)
    u, v, w = (B.membership(words, x) for x in (u, v, w))
    value = np.zeros(len(w))
    known = np.flatnonzero(v >= 0)
    value[known] = trie.word_back.get(v[known])
    pair, before, triple = (np.full(len(w), -1, np.int64) for _ in range(3))
    has = np.flatnonzero((v >= 0) & (w >= 0))
    pair[has] = _once(trie.pair, v[has], w[has])
    replaced = pair >= 0
    value[replaced] = trie.pair_p.get(pair[replaced])
    two = np.flatnonzero((u >= 0) & (v >= 0))
    before[two] = _once(trie.pair, u[two], v[two])
    both = np.flatnonzero((before >= 0) & replaced)
    triple[both] = trie.triple(before[both], v[both], pair[both])
    weight = np.flatnonzero((before >= 0) & (triple < 0))
    value[weight] += trie.pair_back.get(before[weight])
    full = triple >= 0
    value[full] = trie.triple_p.get(triple[full])
    return value, replaced


def read_piece(column: pa.Array, model: TrigramModel) -> tuple[dict, tuple]:
    """Per row: tokens, known tokens, sums over tokens in memory, the other tokens; and (u, v, w, row) of all n-grams.

    v is a word of the model, u the one before it (-1: none or not in the model), w the same for the token after it.
    """
    h, row = tokens(column)
    n = len(column)
    number = model.vocabulary.numbers(h)
    known = number >= 0
    base = np.zeros(len(h))
    base[known] = model.base(model.vocabulary.counts(number[known]))
    if len(model.head):
        rest = np.flatnonzero(~known)
        head = B.membership(model.head, h[rest])
        rest, head = rest[head >= 0], head[head >= 0]
        base[rest], known[rest] = model.base(model.counts[head]), True
    at = np.flatnonzero((number[:-1] >= 0) & (row[1:] == row[:-1]))
    u = np.where((at > 0) & (row[at - 1] == row[at]), number[at - 1], -1)
    tail = ~known
    return {
        "n": np.bincount(row, minlength=n), "known": np.bincount(row, known, n).astype(np.int64),
        "base": np.bincount(row, base, n), "tail": h[tail], "tail_first": np.searchsorted(row[tail], np.arange(n + 1)),
    }, (u, number[at], number[at + 1], row[at])


def _packed(held: list[tuple], model: TrigramModel) -> list[tuple[int, int, bytes]]:
    """(part, n-grams, packed n-grams) of a chunk."""
    u, v, w, place = (np.concatenate(x) for x in zip(*held))
    if not len(u):
        return []
    part = model.part_of(u, v)
    order = np.argsort(v << _BITS | u + 1)  # like n-grams together, for the packing
    order = order[np.argsort(part[order].astype(np.uint16 if model.parts < 1 << 16 else np.int64), kind="stable")]
    return [(int(part[spot[0]]), len(spot), _pack(u[spot], v[spot], w[spot], place[spot]))
            for spot in np.split(order, np.flatnonzero(np.diff(part[order])) + 1)]


def score_documents(
    docs: DataFrame, held_out: Column, head: float = HEAD, keep: float = KEEP, part: int = PART
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null text is empty and has one token, the end. Rows where ``held_out`` is not
    true train the model. Repeated rows count each time. Without any training row
    no token is known and both scores are those of unseen tokens. Documents and their
    n-grams leave in one shuffle, so nothing depends on the order of ``docs`` being
    the same twice, but for a task that is run again after a loss.
    """
    scratch = Scratch(docs.sparkSession, "scoring")
    source = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model, table = train(source.select("text", "held_out"), scratch, head, keep, part)
    hot = _hot_followers(source, model, scratch) if model.spread else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType)])
    for name, kind in (
            ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
            ("base", T.DoubleType()), ("rare", T.ArrayType(T.LongType())), ("row", T.LongType()),
            ("part", T.LongType()), ("chunk", T.LongType()), ("n", T.IntegerType()), ("blob", T.BinaryType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row of the result is a document (part below 0), or the n-grams of a chunk of documents for one part
        chunk, held, size, rows = TaskContext.get().partitionId() << 20, [], 0, 0
        for batch in batches:
            kinds = [batch.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
                     pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            for piece in B.pieces(batch, "text"):
                s, (u, v, w, row) = read_piece(piece.column("text"), shared.value)
                count = piece.num_rows
                rare = pa.ListArray.from_arrays(pa.array(s["tail_first"].astype(np.int32)), pa.array(s["tail"].view(np.int64)))
                spot = (chunk << _SPOT) + rows + np.arange(count)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("held_out"), pa.array(s["n"]), pa.array(s["known"]),
                    pa.array(s["base"]), rare, pa.array(spot), pa.array(np.full(count, -1 - chunk)),
                    *(pa.nulls(count, t) for t in kinds[8:])], names=schema.names)
                held.append((u, v, w, (row + rows) << 1 | ~_flags(piece)[row]))
                size, rows = size + len(u), rows + count
                if max(size, rows) >= GRAMS:
                    yield from emit(held, chunk, kinds)
                    chunk, held, size, rows = chunk + 1, [], 0, 0
        if held:
            yield from emit(held, chunk, kinds)

    def emit(held: list[tuple], chunk: int, kinds: list) -> Iterator[pa.RecordBatch]:
        made = _packed(held, shared.value)
        if made:
            parts, n, blobs = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(made), t) for t in kinds[:7]), pa.array(parts, pa.int64()),
                 pa.array([chunk] * len(made), pa.int64()), pa.array(n, pa.int32()), pa.array(blobs, pa.binary())],
                names=schema.names)

    def look_up(rows: pa.Table) -> pa.Table:
        if rows.column("part")[0].as_py() < 0:
            return rows  # documents go on as they are
        made = look_up_part(rows.select(["chunk", "n", "blob"]).to_pandas(), shared.value)
        return pa.table([pa.array(made[f.name].tolist(), f.type) if f.name in made else pa.nulls(len(made), f.type)
                         for f in rows.schema], schema=rows.schema)

    read = source.mapInArrow(run, schema)
    if hot is not None:
        read = read.unionByName(hot, allowMissingColumns=True)
    read = scratch.write(read.groupBy("part").applyInArrow(look_up, schema), "read")
    sums = read.where("blob is not null").select("chunk", "n", "blob")
    sums = sums.groupBy("chunk").applyInPandas(add_up, "row long, more double")
    documents = read.where("part < 0")
    scored = documents.select("doc_id", "held_out", "n_tokens", "n_known", "base", "row")
    unseen = float(model.base(np.zeros(1))[0])
    scale = F.lit(model.total + 0.5 * (model.distinct + 1))
    rare = documents.select("row", F.explode("rare").alias("word"))
    found = rare.join(table.select("word", "c"), "word", "left").select(
        "row", F.when(F.col("c").isNull(), F.lit(unseen)).otherwise(F.log10((F.col("c") + 0.5) / scale)).alias("base_more"),
        F.col("c").isNotNull().cast("int").alias("known_more"), F.lit(0.0).alias("more"))
    both = found.unionByName(sums.select("row", F.lit(0.0).alias("base_more"), F.lit(0).alias("known_more"), "more"))
    both = both.groupBy("row").agg(*(F.sum(x).alias(x) for x in ("base_more", "known_more", "more")))
    base = F.col("base") + F.coalesce("base_more", F.lit(0.0))
    return scored.join(both, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
