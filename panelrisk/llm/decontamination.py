"""Benchmark windows found in documents by FM-indexes over shards of the corpus.

Each piece of a document partition is a training shard. Its words are mapped to
the vocabulary of the benchmark; stretches of other words cannot hold a window
and leave the shard. The rest is indexed: suffixes ordered through the window
length, the column of preceding words in a wavelet tree, suffix positions. All
windows are searched backwards at once, a word at a time, by two ranks in the
tree; located occurrences become spans, merged per document.

The benchmark is read in blocks of bounded bytes (``BLOCK_BYTES``), each sent to
the tasks once; spans of several blocks are merged per document at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B

WINDOW = 10
BLOCK_BYTES = 32 << 20


class WaveletTree:
    """Rank queries over a sequence of symbols, one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.ranks = []
        self.zeros = []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ranks.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the position ``end``."""
        low = np.zeros_like(end)
        for depth in range(self.bits):
            bit = (symbol >> (self.bits - 1 - depth)) & 1
            ones = self.ranks[depth]
            low = np.where(bit == 1, self.zeros[depth] + ones[low], low - ones[low])
            end = np.where(bit == 1, self.zeros[depth] + ones[end], end - ones[end])
        return end - low


class FMIndex:
    """Index of a symbol sequence for patterns of up to ``depth`` symbols.

    Suffixes are ordered through ``depth`` symbols only: backward search counts
    symbols before a range, and no pattern is longer than that order.
    """

    def __init__(self, text: np.ndarray, size: int, depth: int):
        order, rank, step = None, text.astype(np.int64), 1
        while True:  # doubling: ranks of step symbols give ranks of 2 * step
            follow = np.full(len(text), -1, np.int64)
            follow[:-step] = rank[step:]
            key = rank * (int(max(rank.max(initial=0), follow.max(initial=0))) + 2) + follow + 1
            order = np.argsort(key, kind="stable")
            moved = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(len(text), np.int64)
            rank[order] = moved
            step *= 2
            if step >= depth or step >= len(text):
                break
        self.positions = order
        previous = text[order - 1].copy()  # the first suffix is preceded by the last symbol
        self.tree = WaveletTree(previous, size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each pattern; rows are padded in front with -1."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.positions), np.int64)
        for at in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((patterns[:, at] >= 0) & (high > low))
            symbol = patterns[live, at]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high


def benchmark_windows(rows: list[tuple], window: int) -> dict:
    """Vocabulary, distinct windows as symbols and the items of each window."""
    texts = pa.array([t for _, t in rows], pa.large_string())
    data, offsets = B.flat_text(texts)
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, offsets, B.ALNUM)
    words = B.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    vocabulary, symbols = np.unique(words, return_inverse=True)
    found: dict[tuple, set] = {}
    for (item, _), a, b in zip(rows, first[:-1], first[1:]):
        own = [int(s) for s in symbols[a:b]]
        for i in range(max(1, len(own) - window + 1) if own else 0):
            found.setdefault(tuple(own[i:i + window]), set()).add(str(item))
    patterns = np.full((len(found), window), -1, np.int64)
    for i, p in enumerate(found):
        patterns[i, window - len(p):] = p
    return {
        "vocabulary": vocabulary, "patterns": patterns,
        "lengths": np.array([len(p) for p in found], np.int64),
        "items": [sorted(s) for s in found.values()],
    }


def find_windows(
    words: np.ndarray, first: np.ndarray, model: dict
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, pattern) of every occurrence in one shard.

    ``first`` holds the number of the first word of each row.
    """
    none = np.zeros(0, np.int64)
    if not len(words) or not len(model["lengths"]):
        return none, none, none
    symbols = B.membership(model["vocabulary"], words)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    known = symbols >= 0
    new_run = np.ones(len(words), bool)
    new_run[1:] = ~known[:-1] | (rows[1:] != rows[:-1])
    run = np.cumsum(new_run & known) - 1
    lengths = np.bincount(run[known], minlength=int(run.max(initial=-1)) + 1)
    keep = known.copy()
    keep[known] = lengths[run[known]] >= model["lengths"].min()
    place = np.flatnonzero(keep)
    if not len(place):
        return none, none, none
    # symbol 0 ends each stretch, so no window crosses it
    gap = np.concatenate([[1], (np.diff(place) != 1) | (np.diff(rows[place]) != 0), [1]])
    gap = np.flatnonzero(gap[1:])  # last word of each stretch
    text = np.insert(symbols[place] + 1, gap + 1, 0)
    back = np.insert(place, gap + 1, -1)
    index = FMIndex(text, len(model["vocabulary"]) + 1, model["patterns"].shape[1])
    low, high = index.search(np.where(model["patterns"] >= 0, model["patterns"] + 1, -1))
    hits = np.maximum(high - low, 0)
    pattern = np.repeat(np.arange(len(hits)), hits)
    offset = np.arange(len(pattern)) - np.repeat(np.cumsum(hits) - hits, hits)
    word = back[index.positions[low[pattern] + offset]]
    return rows[word], word - first[rows[word]], pattern


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _scan(batch: pa.RecordBatch, model: dict) -> pa.RecordBatch:
    data, offsets = B.flat_text(batch.column("text"))
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, offsets, B.ALNUM)
    words = B.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    row, word, pattern = find_windows(words, first, model)
    n = batch.num_rows
    spans: list[list] = [[] for _ in range(n)]
    byte_spans: list[list] = [[] for _ in range(n)]
    items: list[list] = [[] for _ in range(n)]
    order = np.argsort(row, kind="stable")
    row, word, pattern = row[order], word[order], pattern[order]
    for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1) if len(row) else []:
        r = int(row[part[0]])
        merged = _merged(word[part], word[part] + model["lengths"][pattern[part]])
        spans[r] = [[a, b] for a, b in merged]
        byte_spans[r] = [
            [int(starts[first[r] + a] - offsets[r]), int(ends[first[r] + b - 1] - offsets[r])]
            for a, b in merged
        ]
        items[r] = sorted({i for p in np.unique(pattern[part]) for i in model["items"][p]})
    pair = pa.list_(pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in batch.schema.names],
         pa.array(np.diff(first), pa.int64()), pa.array(spans, pair), pa.array(byte_spans, pair),
         pa.array(items, pa.list_(pa.string()))],
        names=[*batch.schema.names, "n_words", "spans", "byte_spans", "items"],
    )


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark in parts of at most about ``block_bytes`` of text each."""
    items = benchmark.select(F.col("item_id"), F.col("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for b in range(blocks):
        part = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [(r[0], r[1]) for r in part.collect()]


def locate_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """(doc_id, text, n_words, spans, byte_spans, items) of every document.

    ``spans`` are merged [first word, end word) pairs hit by a window, and
    ``byte_spans`` the same in UTF-8 bytes. Null text has no words and stays
    null. Repeated rows are scanned each on its own. An empty benchmark hits
    nothing. ``then`` turns these columns into (doc_id, text) in the same tasks.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    pairs = T.ArrayType(T.ArrayType(T.LongType()))
    schema = (
        T.StructType(list(source.schema.fields)).add("n_words", T.LongType()).add("spans", pairs)
        .add("byte_spans", pairs).add("items", T.ArrayType(T.StringType()))
    )
    blocks = [docs.sparkSession.sparkContext.broadcast(benchmark_windows(rows, window))
              for rows in item_blocks(benchmark, block_bytes)]

    def scanned(shared, finish=None, finished=schema) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in B.pieces(batch, "text"):
                    found = _scan(piece, shared.value)
                    yield finish(found) if finish else found

        return source.mapInArrow(scan, finished)

    if len(blocks) == 1:
        # one function for both: a second one would be a second worker beside each task
        return scanned(blocks[0], then, source.schema if then else schema)
    # several benchmark blocks: a document is scanned once per block, its spans meet by row
    found = _merge_blocks([scanned(b) for b in blocks])
    if then is None:
        return found
    return found.select("doc_id", "text", "byte_spans").mapInArrow(
        lambda batches: map(then, batches), source.schema)


def _merge_blocks(parts: list[DataFrame]) -> DataFrame:
    tagged = [p.withColumn("_copy", F.xxhash64("doc_id", "text")) for p in parts]
    union = tagged[0]
    for p in tagged[1:]:
        union = union.unionByName(p)
    # equal rows have equal spans, so they may share them
    merged = union.groupBy("doc_id", "_copy").agg(
        F.any_value("text").alias("text"), F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("byte_spans"))).alias("byte_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / F.lit(len(parts))).cast("int").alias("_times"),
    )
    union_of = """aggregate(array_sort({c}), cast(array() as array<array<bigint>>), (acc, x) ->
      case when size(acc) > 0 and x[0] <= element_at(acc, -1)[1]
      then concat(slice(acc, 1, size(acc) - 1),
                  array(array(element_at(acc, -1)[0], greatest(element_at(acc, -1)[1], x[1]))))
      else concat(acc, array(x)) end)"""
    return merged.select(
        "doc_id", "text", "n_words", F.expr(union_of.format(c="spans")).alias("spans"),
        F.expr(union_of.format(c="byte_spans")).alias("byte_spans"), "items",
        F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_i"),
    ).drop("_i")


def digest(found: DataFrame) -> DataFrame:
    """Counts and item digest per document."""
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s[1] - s[0])")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def cut_spans(text: bytes, spans: list) -> bytes:
    """The text without the given byte spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def remove_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the words of benchmark windows, columns as given.

    A document without a hit keeps its text to the byte; one that is hit loses
    the merged spans from the first to the last byte of their words. Columns
    other than ``text`` and ``n_chars`` are passed on as they are.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select(F.struct("doc_id", *rest).alias("doc_id"), "text")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column("text").to_pylist(), batch.column("byte_spans").to_pylist()
        out = [t if not s else cut_spans(t.encode(), s).decode() for t, s in zip(texts, spans)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    clean = locate_windows(packed, benchmark, window, then=cut)
    out = clean.select("doc_id.*", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
