"""Language of a text by character models with interpolated Kneser-Ney smoothing.

Each language has a model of up to ``ORDER`` characters. Every order is one sorted
hash array shared by the languages, with a column of values per language. A text
gets the language of lowest cross-entropy per character. A text whose best
cross-entropy is above what training texts of that language show is flagged as
rejected.

The models are fitted on the whole texts of at most ``DOCS_PER_LANGUAGE`` documents
per language in hash order; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B
from panelrisk.llm.sampling import sample_ids

ORDER = 5
DOCS_PER_LANGUAGE = 800
ALPHABET = 50_000  # characters an unseen one is drawn from
SHARPNESS = 25.0   # nats per character that one unit of log odds stands for, inverted
QUANTILE = 0.999
NONE = "und"

_alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters, runs of other characters as one space, and the first place of each text.

    Each text starts with a space, so that its first letters have a context.
    """
    joined = "\x00".join([" ".join(("", t or "")) for t in texts] + [""]).lower() if texts else ""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _collapsed(codes, len(texts))


def _collapsed(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    stop = codes == 0
    is_letter = _alpha[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] = True
    keep[1:] |= stop[:-1]  # the space in front of each text
    keep &= ~stop
    text = np.cumsum(stop)[keep]
    chars = np.where(is_letter, codes, 32)[keep]
    return chars, np.searchsorted(text, np.arange(n + 1))


def clean(texts: list[str | None]) -> list[str | None]:
    return [None if t is None else t.replace("\x00", " ") for t in texts]


def _char_hash(chars: np.ndarray) -> np.ndarray:
    power, _ = B.powers(len(chars))
    out = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(B.mix(chars.astype(np.uint64) + np.uint64(0x51ED)) * power, out=out[1:])
    return out


def grams(chars: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of one order that stay inside a text, and their last places."""
    last = np.arange(len(chars))
    begin = np.repeat(first[:-1], np.diff(first))
    last = last[last - order + 1 >= begin]
    return B.span_hash(_char_hash(chars), last - order + 1, last + 1), last


class LanguageModel:
    """Per order: sorted hashes of n-grams with discounted shares and of contexts with weights."""

    def __init__(self, names: list[str], tables: list, contexts: list, floor: np.ndarray, limits: np.ndarray):
        self.names, self.tables, self.contexts, self.floor, self.limits = names, tables, contexts, floor, limits

    def entropies(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Nats per character of each text (rows) in each language (columns)."""
        n, width = len(first) - 1, len(self.names)
        if not len(chars):
            return np.zeros((n, width))
        prefix = _char_hash(chars)
        at = np.arange(len(chars))
        begin = np.repeat(first[:-1], np.diff(first))
        long = np.minimum(at - begin + 1, ORDER)  # characters up to here that may be used
        key = B.span_hash(prefix, at - long + 1, at + 1)
        _, where, back = np.unique(key, return_index=True, return_inverse=True)
        p = np.repeat(self.floor[None, :], len(where), 0)
        for order in range(1, ORDER + 1):
            live = np.flatnonzero(long[where] >= order)
            spot = where[live]
            share = self._find(self.tables[order - 1], B.span_hash(prefix, spot - order + 1, spot + 1), 0.0)
            weight = self._find(self.contexts[order - 1], B.span_hash(prefix, spot - order + 1, spot), 1.0)
            p[live] = share + weight * p[live]
        log_p = np.log(p)[back]
        row = np.repeat(np.arange(n), np.diff(first))
        total = np.column_stack([np.bincount(row, log_p[:, k], n) for k in range(width)])
        return -total / np.maximum(np.diff(first), 1)[:, None]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, absent: float) -> np.ndarray:
        at = B.membership(table[0], keys)
        out = table[1][at].astype(np.float64) if len(table[0]) else np.full((len(keys), table[1].shape[1]), absent)
        out[at < 0] = absent
        return out


def build(names: list[str], counts: dict[int, list], limits: np.ndarray) -> LanguageModel:
    """Model from, per order, (language, n-gram, context, shorter n-gram, count) arrays."""
    width = len(names)
    tables, contexts = [], []
    floor = np.full(width, 1 / ALPHABET)
    for order in range(1, ORDER + 1):
        lang, gram, context, _, count = counts[order]
        if order < ORDER:  # how many different characters stand before the n-gram
            lang2, _, _, shorter, _ = counts[order + 1]
            seen = _by_key(lang2, shorter, np.ones(len(lang2)))
            value = seen.get_many(lang, gram)
            # n-grams at the start of a text have nothing before them
            value = np.where(value > 0, value, np.minimum(count, 1))
        else:
            value = count.astype(float)
        ones, twos = (value == 1).sum(), (value == 2).sum()
        discount = ones / (ones + 2 * twos) if ones + twos else 0.5
        discount = float(np.clip(discount, 0.05, 0.95))
        total = _by_key(lang, context, value)
        kinds = _by_key(lang, context, np.ones(len(value)))
        share = np.maximum(value - discount, 0) / total.get_many(lang, context)
        tables.append(_columns(lang, gram, share, width, 0.0))
        ctx_lang, ctx = total.lang, total.key
        weight = discount * kinds.value / total.value
        contexts.append(_columns(ctx_lang, ctx, weight, width, 1.0))
    return LanguageModel(names, tables, contexts, floor, limits)


class _by_key:
    """Sums by (language, hash)."""

    def __init__(self, lang: np.ndarray, key: np.ndarray, value: np.ndarray):
        mixed = B.mix(key + lang.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.mixed, first, back = np.unique(mixed, return_index=True, return_inverse=True)
        self.lang, self.key = lang[first], key[first]
        self.value = np.bincount(back, value, len(first))

    def get_many(self, lang: np.ndarray, key: np.ndarray) -> np.ndarray:
        at = B.membership(self.mixed, B.mix(key + lang.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return np.where(at >= 0, self.value[at], 0.0)


def _columns(lang: np.ndarray, key: np.ndarray, value: np.ndarray, width: int, absent: float):
    keys, back = np.unique(key, return_inverse=True)
    out = np.full((len(keys), width), absent, np.float32)
    out[back, lang] = value
    return keys, out


def train(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel | None:
    """Model from documents with text and language where ``usable`` holds; None without any."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = sample_ids(rows, per_language, "lang").collect()
    if not ids:
        return None
    names = sorted({r["lang"] for r in ids})
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(i,) for i in {r["doc_id"] for r in ids}], T.StructType([docs.schema["doc_id"]]))
    # at most per_language ids for each language
    sample = rows.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    schema = "lang int, ord int, gram long, context long, shorter long, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                yield from count_piece(piece)

    def count_piece(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lang_of = np.array([names.index(x) for x in piece.column("lang").to_pylist()], np.int32)
        chars, first = letters(clean(piece.column("text").to_pylist()))
        lang = np.repeat(lang_of, np.diff(first))
        prefix = _char_hash(chars)
        for order in range(1, ORDER + 1):
            gram, last = grams(chars, first, order)
            mixed = _by_key(lang[last].astype(np.int64), gram, np.ones(len(last)))
            _, where = np.unique(B.mix(gram + lang[last].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
            spot = last[where]
            n = len(spot)
            yield pa.RecordBatch.from_arrays([
                pa.array(lang[spot]), pa.array(np.full(n, order, np.int32)),
                pa.array(mixed.key.view(np.int64)),
                pa.array(B.span_hash(prefix, spot - order + 1, spot).view(np.int64)),
                pa.array(B.span_hash(prefix, spot - order + 2, spot + 1).view(np.int64)),
                pa.array(mixed.value.astype(np.int64)),
            ], names=["lang", "ord", "gram", "context", "shorter", "n"])

    pdf = (
        sample.mapInArrow(count, schema)
        .groupBy("lang", "ord", "gram").agg(F.first("context").alias("context"), F.first("shorter").alias("shorter"), F.sum("n").alias("n"))
        .toPandas()  # distinct n-grams of up to ORDER characters in at most per_language texts of a language
    )
    counts = {}
    for order in range(1, ORDER + 1):
        part = pdf[pdf["ord"] == order]
        counts[order] = [
            part["lang"].to_numpy(np.int64), *[part[c].to_numpy(np.int64).view(np.uint64) for c in ("gram", "context", "shorter")],
            part["n"].to_numpy(np.int64),
        ]
    model = build(names, counts, np.full(len(names), np.inf))
    model.limits = _limits(sample, model)
    return model


def _limits(sample: DataFrame, model: LanguageModel) -> np.ndarray:
    """Cross-entropy that all but a few training texts of a language stay under, with a margin."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                lang = np.array([shared.value.names.index(x) for x in piece.column("lang").to_pylist()])
                chars, first = letters(clean(piece.column("text").to_pylist()))
                h = shared.value.entropies(chars, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.int32()), pa.array(h[np.arange(len(lang)), lang])], names=["lang", "h"])

    found = (
        sample.select("lang", "text").mapInArrow(own, "lang int, h double").groupBy("lang")
        .agg(F.percentile("h", F.lit(QUANTILE)).alias("q")).collect()
    )
    out = np.full(len(model.names), np.inf)
    for r in found:
        out[r["lang"]] = 1.25 * r["q"]
    return out


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) of every document's whole text.

    ``und`` with score 0 if the text is null or has no letter, or if there is no model.
    Equal cross-entropies go to the first language in the alphabet. ``rejected``
    marks texts unlike the training texts of their language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"]]).add("lang_pred", T.StringType())
    schema = schema.add("score", T.DoubleType()).add("entropy", T.DoubleType()).add("rejected", T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                yield _identified(piece, shared.value, schema.names)

    return source.mapInArrow(run, schema)


def _identified(piece: pa.RecordBatch, model: LanguageModel | None, names: list[str]) -> pa.RecordBatch:
    n = piece.num_rows
    chars, first = letters(clean(piece.column("text").to_pylist()))
    has_letter = np.bincount(np.repeat(np.arange(n), np.diff(first)), chars != 32, n) > 0
    if model is None:
        has_letter[:] = False
        best, score, h, rejected = np.zeros(n, int), np.zeros(n), np.zeros(n), np.zeros(n, bool)
    else:
        every = model.entropies(chars, first)
        best = every.argmin(1)
        h = every[np.arange(n), best]
        score = 1 / np.exp(-SHARPNESS * (every - h[:, None])).sum(1)
        rejected = h > model.limits[best]
    lang = [model.names[b] if ok else NONE for b, ok in zip(best, has_letter)]
    return pa.RecordBatch.from_arrays([
        piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.where(has_letter, score, 0.0)),
        pa.array(np.where(has_letter, h, 0.0)), pa.array(np.where(has_letter, rejected, True)),
    ], names=names)
