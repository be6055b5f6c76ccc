"""Spelling variants: words that differ by one code point, found in bidirectional FM-indexes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelrisk.llm.bytesops import LOWER, pieces
from panelrisk.llm.scratch import Scratch
from panelrisk.llm.wavelet import WaveletMatrix, rotation_order
from panelrisk.operators.joining import lookup_join

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = 6  # code points of the shortest word
LEAST = 5  # occurrences of the rarest word
CHANGED = 199  # one run in so many loses a code point
RATIO = 5  # a form is so many times as frequent
HELD = 200_000  # distinct words a task counts before it passes them on
SHARD = 8192  # words of one index
AT_ONCE = 4096  # words searched together
LOWER_TABLE = bytes(LOWER)


def changed_runs(key: str, runs: Counter) -> Iterator[tuple[str, int]]:
    """Runs of one document with one in ``CHANGED`` of them shortened, as its crc32 says."""
    start = zlib.crc32(f"{key}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % CHANGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LETTERS:
            yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words (word, n) of whole texts that are long and frequent enough.

    Null texts have no words; a null ``doc_id`` counts as empty text in the hash.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return rows

        for batch in batches:
            for piece in pieces(batch, "text"):
                for key, text in zip(piece.column("key").to_pylist(), piece.column("text").cast(pa.binary()).to_pylist()):
                    if text:
                        found = Counter(RUN.findall(text.translate(LOWER_TABLE).decode("utf-8", "replace")))
                        for word, n in changed_runs(key, found):
                            held[word] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST)


class TwoWayIndex:
    """FM-indexes of the words, joined by a delimiter, and of the same text backwards.

    A state is the interval of a pattern in both of them (first row, first row of
    the reversed pattern, length). The text is read as a ring, so that every word
    has a delimiter on both sides.
    """

    def __init__(self, words: list[str]):
        joined = "\0" + "\0".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(points, return_inverse=True)
        text = text.astype(np.int64)
        counts = np.bincount(text, minlength=len(self.alphabet))
        self.below = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.n = len(text)
        order = rotation_order(text)
        self.left_of = WaveletMatrix(np.roll(text, 1)[order], len(self.alphabet))
        back = text[::-1]
        self.right_of = WaveletMatrix(np.roll(back, 1)[rotation_order(back)], len(self.alphabet))
        # rows of the delimiters come first: the only suffix positions that are kept
        self.word_at = np.searchsorted(np.flatnonzero(text == 0), order[:len(words)])

    def codes(self, words: list[str]) -> np.ndarray:
        """Symbols of words, one row each: delimiter, letters, delimiter; -1 beyond and for letters not here."""
        size = np.array([len(w) for w in words], np.int64)
        out = np.full((len(words), int(size.max(initial=0)) + 2), -1, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        at = np.where(self.alphabet[at] == points, at, -1)
        row = np.repeat(np.arange(len(words)), size)
        column = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
        out[row, column + 1] = at
        out[np.arange(len(words)), 0] = 0
        out[np.arange(len(words)), size + 1] = 0
        return out

    def all(self, rows: int) -> np.ndarray:
        """State of the empty pattern for so many rows: query, row, row backwards, length."""
        state = np.zeros((4, rows), np.int64)
        state[0] = np.arange(rows)
        state[3] = self.n
        return state

    def extend(self, state: np.ndarray, c: np.ndarray, right: bool) -> np.ndarray:
        """States after one more symbol on a side; those that are nowhere go."""
        state, c = state[:, c >= 0], c[c >= 0]
        here, there = (2, 1) if right else (1, 2)
        matrix = self.right_of if right else self.left_of
        a, b, smaller = matrix.range(c, state[here], state[here] + state[3])
        out = state.copy()
        out[here], out[there], out[3] = self.below[c] + a, state[there] + smaller, b - a
        return out[:, b > a]

    def letters(self, state: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """States after every possible letter on a side, and the letters."""
        here, there = (2, 1) if right else (1, 2)
        matrix = self.right_of if right else self.left_of
        row, c, a, b, smaller = matrix.symbols(state[here], state[here] + state[3])
        row, c, a, b, smaller = (x[c > 0] for x in (row, c, a, b, smaller))
        out = state[:, row]
        out[here], out[there], out[3] = self.below[c] + a, state[there][row] + smaller, b - a
        return out, c


def one_error(index: TwoWayIndex, words: list[str], half: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexed words within one error of each word, the error outside one exact half.

    ``right``: the first ``half`` letters match exactly and the search goes on to
    the right, else the last ``half`` letters and to the left. Returns rows of
    ``words`` and of the indexed words.
    """
    codes = index.codes(words)
    size = np.array([len(w) for w in words], np.int64)
    rows = np.arange(len(words))
    exact = index.all(len(words))
    # the half and its outer delimiter, from the inner end outwards
    for k in range(int(half.max(initial=0)) + 1):
        on = half[exact[0]] >= k
        q = exact[0][on]
        at = half[q] - k if right else size[q] - half[q] + 1 + k
        exact = np.concatenate([exact[:, ~on], index.extend(exact[:, on], codes[q, at], not right)], 1)
    rest = size - half  # letters where the error may be
    start = half + 1 if right else rest
    step = 1 if right else -1

    def wanted(q: np.ndarray, t: int) -> np.ndarray:
        """Letter ``t`` of the rest of each query, -2 at its end."""
        at = np.clip(start[q] + step * t, 0, codes.shape[1] - 1)
        return np.where(t < rest[q], codes[q, at], -2)

    found = []
    failed = np.zeros((4, 0), np.int64)  # states with their one error
    for t in range(int(rest.max(initial=0)) + 1):
        want = wanted(exact[0], t)
        other, c = index.letters(exact, right)
        fresh = c != wanted(other[0], t)
        other = other[:, fresh]
        more = np.concatenate([failed, other], 1)  # an inserted letter stays at t
        ended = rest[more[0]] == t
        found.append(more[:, ended])
        more = more[:, ~ended]
        open_ = want != -2
        failed = np.concatenate([
            index.extend(more, wanted(more[0], t), right),
            other[:, rest[other[0]] > t],  # a replaced letter
            exact[:, open_],  # a deleted letter
        ], 1)
        exact = index.extend(exact[:, open_], want[open_], right)
    ends = np.concatenate([*found, failed[:, rest[failed[0]] == int(rest.max(initial=0)) + 1]], 1)
    ends = index.extend(ends, np.zeros(ends.shape[1], np.int64), right)
    ends = ends[:, np.argsort(ends[0], kind="stable")]
    return rows[ends[0]], index.word_at[ends[1]]


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs (word, n, near, near_n) of words with exactly one inserted, deleted or replaced code point.

    The error lies outside the first or outside the last half of the near word.
    Words are indexed under both halves; a word asks under the halves a near word
    of one letter less, the same and one more can have. Halves are dealt to shards
    of about ``SHARD`` words; a half with more words than that is cut into blocks,
    and its askers too, so that no task grows with it.
    """
    spark = vocabulary.sparkSession
    store = Scratch(spark, "spelling")
    size = F.char_length("word")
    words = vocabulary.select("word", "n", size.alias("size"))
    left, right = F.lit("left").alias("side"), F.lit("right").alias("side")

    def first(k):
        return F.expr(f"left(word, {k})").alias("part")

    def last(k):
        return F.expr(f"right(word, {k})").alias("part")

    held = words.select("word", "n", left, first("size div 2")).unionAll(
        words.select("word", "n", right, last("size - size div 2")))
    lengths = words.withColumn("m", F.explode(F.sequence(F.col("size") - 1, F.col("size") + 1)))
    asked = lengths.select("word", "n", left, first("m div 2")).unionAll(
        lengths.select("word", "n", right, last("m - m div 2"))).distinct()
    counts = held.groupBy("side", "part").agg(F.count(F.lit(1)).alias("held"))
    large = store.write(counts.where(F.col("held") > SHARD), "large").select(
        "side", "part", F.ceil(F.col("held") / SHARD).cast("int").alias("blocks"))
    shards = 1 + 2 * vocabulary.count() // SHARD

    def dealt(rows, own, other, word, n):
        rows = lookup_join(rows, large, ["side", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        return rows.select(
            F.col("word").alias(word), F.col("n").alias(n), "side", F.char_length("part").alias("half"),
            F.pmod(F.xxhash64("side", "part"), F.lit(shards)).alias("shard"),
            F.pmod(F.xxhash64("word"), "blocks").alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), (F.col("blocks") - 1).cast("long"))).alias(other))

    def search(index_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for side, asked_rows in query_rows.groupby("side"):
            mine = index_rows[index_rows["side"] == side]
            if not len(mine):
                continue
            mine = mine.reset_index(drop=True)
            index = TwoWayIndex(mine["near"].tolist())
            own_half = mine["half"].to_numpy()
            for at in range(0, len(asked_rows), AT_ONCE):
                some = asked_rows.iloc[at:at + AT_ONCE]
                half = some["half"].to_numpy(np.int64)
                row, near = one_error(index, some["word"].tolist(), half, side == "left")
                keep = own_half[near] == half[row]
                row, near = row[keep], near[keep]
                out.append(pd.DataFrame({
                    "word": some["word"].to_numpy()[row], "n": some["n"].to_numpy()[row],
                    "near": mine["near"].to_numpy()[near], "near_n": mine["near_n"].to_numpy()[near],
                }))
        empty = pd.DataFrame({"word": [], "n": np.zeros(0, np.int64), "near": [], "near_n": np.zeros(0, np.int64)})
        return pd.concat([empty, *out])

    keys = ["shard", "index_block", "query_block"]
    pairs = dealt(held, "index_block", "query_block", "near", "near_n").groupBy(*keys).cogroup(
        dealt(asked, "query_block", "index_block", "word", "n").groupBy(*keys)
    ).applyInPandas(search, "word string, n long, near string, near_n long")
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """Last form of every word (word, root) of a table (word, form).

    Forms grow more frequent at every step, so there is no ring; every turn
    doubles the steps a root has followed.
    """
    store = Scratch(forms.sparkSession, "roots")
    known = store.write(forms.select("word", F.col("form").alias("root")), "0")
    turn = 0
    while True:
        turn += 1
        further = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        known = store.write(
            known.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            str(turn))
        if not known.where("moved").limit(1).count():
            return known.drop("moved")
        known = known.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """Every word of the documents with its near words, form and root.

    Null and empty texts have no words, repeated rows count as often as they
    occur, an empty table gives no row, other columns are ignored. Ties of the
    form go to the smallest word.
    """
    store = Scratch(docs.sparkSession, "variants")
    words = store.write(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    near = store.write(
        near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")).select(
            "word", "n_near",
            *[F.when(-F.col("best.m") >= RATIO * F.col("n"), c).alias(name)
              for name, c in (("form", F.col("best.w")), ("form_n", -F.col("best.m")))]),
        "near")
    root = roots(near.where("form is not null").select("word", "form"))
    return words.join(near, "word", "left").join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
