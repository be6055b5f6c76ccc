"""Quality classifier from trusted positives and unlabelled text.

The risk of a linear model is minimised in its non-negative unbiased form: the
part of the unlabelled risk that positives explain is taken off and never goes
below zero. The share of good text is estimated from the data: the smallest
ratio of unlabelled to positive texts above a score bounds it. Labelled rows
then only place the score on the scale of a probability.

The model is fitted on at most ``SAMPLE`` positives, ``SAMPLE`` unlabelled and
``SAMPLE`` labelled rows in hash order; every document is scored on its whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelrisk.llm import bytesops as B
from panelrisk.llm.sampling import sample_ids

SAMPLE = 6000
STEPS, RATE, SHRINK = 400, 0.05, 1e-4
CUT = 0.3
BUCKETS = 256
FOLDS = 3    # parts of the fitting rows, each judged by the others when the prior is estimated
ROWS = 256   # texts whose features are in memory at once


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text: byte shares, word shapes and repetition. Null counts as empty."""
    data, offsets = B.flat_text(column)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
    share = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    starts, ends, first = B.word_spans(data, offsets, B.SPACE)
    words = np.diff(first)
    word_row = np.repeat(np.arange(n), words)
    many = np.maximum(words, 1)
    lengths = ends - starts
    mean = np.bincount(word_row, lengths, n) / many
    spread = np.sqrt(np.maximum(np.bincount(word_row, lengths.astype(float) ** 2, n) / many - mean ** 2, 0))
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    other = np.concatenate([[0], np.cumsum(~_LETTER[data])])
    shouted = np.bincount(word_row, (upper[ends] - upper[starts]) * 2 > lengths, n) / many
    marked = np.bincount(word_row, (other[ends] - other[starts]) * 2 >= lengths, n) / many
    hashes = B.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    distinct = _distinct(word_row, hashes, n) / many
    pair = hashes[1:] * np.uint64(3) + hashes[:-1] if len(hashes) else hashes
    inside = word_row[1:] == word_row[:-1]
    pairs = _distinct(word_row[1:][inside], B.mix(pair[inside]), n) / np.maximum(words - 1, 1)
    again = np.bincount(word_row[1:][inside], (hashes[1:] == hashes[:-1])[inside], n) / many
    bucket = (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS
    hashed = np.bincount(word_row * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    shapes = np.column_stack([
        np.log1p(sizes), np.log1p(words), mean, spread, shouted, marked, distinct, pairs,
        distinct ** 2, pairs ** 2, np.minimum(distinct, 0.3), np.minimum(pairs, 0.6), again,
        (words == 0).astype(float),
    ])
    return np.hstack([share, np.sqrt(hashed / many[:, None]), shapes]).astype(np.float32)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_LETTER[128:] = True


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    if not len(row):
        return np.zeros(n)
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    fresh = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])])
    return np.bincount(r[fresh], minlength=n).astype(float)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    slope: float
    shift: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class _Adam:
    def __init__(self, size: int):
        self.m, self.v, self.t = np.zeros(size), np.zeros(size), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient ** 2
        return RATE * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def estimate_prior(folds: list[tuple[np.ndarray, np.ndarray]]) -> float:
    """Largest share of positives that the scores of unlabelled rows allow.

    ``folds`` holds scores of positives and of unlabelled rows, each by weights that
    were fitted without them. For each cut, a quantile of the positives of its fold,
    the share of unlabelled rows above it is compared with that of positives; the
    smallest ratio, with a margin for the sample size, is kept.
    """
    levels = np.linspace(0.02, 0.9, 45)
    above_p, above_u, positives, unlabelled = np.zeros(45), np.zeros(45), 0, 0
    for p, u in folds:
        cuts = np.quantile(p, levels)
        above_p += (p >= cuts[:, None]).sum(1)
        above_u += (u >= cuts[:, None]).mean(1) * len(u)
        positives, unlabelled = positives + len(p), unlabelled + len(u)
    above_p, above_u = above_p / positives, above_u / unlabelled
    noise = np.sqrt(np.log(40) / (2 * positives)) + np.sqrt(np.log(40) / (2 * unlabelled))
    best = int(np.argmin((above_u + noise) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def _held_out_scores(p: np.ndarray, u: np.ndarray, fold_p: np.ndarray, fold_u: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores of each fold by weights of the others; a fold without rows of both kinds joins no list."""
    out = []
    for k in range(FOLDS):
        own_p, own_u = fold_p == k, fold_u == k
        if own_p.any() and own_u.any() and not own_p.all() and not own_u.all():
            w = _discriminate(p[~own_p], u[~own_u])[:-1]
            out.append((p[own_p] @ w, u[own_u] @ w))
    if not out:
        w = _discriminate(p, u)[:-1]
        out.append((p @ w, u @ w))
    return out


def _discriminate(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Weights that tell positives from unlabelled rows."""
    w, adam = np.zeros(p.shape[1] + 1), _Adam(p.shape[1] + 1)
    for _ in range(STEPS // 2):
        gp = _sigmoid(p @ w[:-1] + w[-1]) - 1
        gu = _sigmoid(u @ w[:-1] + w[-1])
        g = np.append((p.T @ gp) / len(p) + (u.T @ gu) / len(u), gp.mean() + gu.mean())
        g[:-1] += 1e-3 * w[:-1]
        w = w - adam.step(g)
    return w


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, labelled: np.ndarray, labels: np.ndarray,
    fold_p: np.ndarray, fold_u: np.ndarray,
) -> QualityModel:
    """Non-negative risk minimiser, put on a probability scale by the labelled rows.

    ``fold_p`` and ``fold_u`` deal the documents of both kinds to folds; a document
    that is of both kinds is in one fold.
    """
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0)
    scale[scale < 1e-6] = np.inf  # a column without spread has no say
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = estimate_prior(_held_out_scores(p, u, fold_p, fold_u))
    w, adam = np.zeros(p.shape[1] + 1), _Adam(p.shape[1] + 1)
    for _ in range(STEPS):
        fp, fu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        sp, su = _sigmoid(fp), _sigmoid(fu)
        # logistic loss: derivative of log(1 + exp(-f)) is s - 1, of log(1 + exp(f)) is s
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp, gu = np.zeros(len(p)), np.zeros(len(u))
        if negative >= 0:
            gp = prior * (sp - 1) - prior * sp
            gu = su
        else:  # the unlabelled part was overfitted: walk it back
            gp, gu = prior * sp, -su
        g = np.append((p.T @ gp) / len(p) + (u.T @ gu) / len(u), gp.mean() + gu.mean())
        g[:-1] += SHRINK * w[:-1]
        w = w - adam.step(g)
    model = QualityModel(mean, scale, w[:-1], float(w[-1]), prior, 1.0, 0.0)
    model.slope, model.shift = _calibrate(model.margin(labelled), labels)
    return model


def _calibrate(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic scale of the margin, each class with soft targets."""
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    centre, width = margin.mean(), margin.std() + 1e-9
    z, a, b = (margin - centre) / width, 1.0, 0.0
    for _ in range(60):  # Newton steps
        s = _sigmoid(a * z + b)
        v = np.maximum(s * (1 - s), 1e-9)
        g = np.array([((s - target) * z).sum() + 1e-3 * a, (s - target).sum()])
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-9]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - move[0], b - move[1]
    a = max(a, 1e-3)
    return float(a / width), float(b - a * centre / width)


def sampled_features(docs: DataFrame, ids: DataFrame) -> list:
    """(doc_id, features) of the documents in a bounded list of ids."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # at most a few times SAMPLE ids
    chosen = source.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id")
    schema = T.StructType([source.schema["doc_id"]]).add("x", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text", ROWS):
                x = features(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["doc_id", "x"])

    return chosen.select("doc_id", "text").mapInArrow(run, schema).collect()


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> QualityModel | None:
    """Model from the rows where ``usable`` holds; None without a labelled or unlabelled row.

    Rows of ``labels`` with a null label or id are left out; a document labelled
    twice counts as good if any of its labels is 1.
    """
    known = (
        labels.where(usable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    good = sample_ids(known.where("quality = 1"), sample)
    bad = sample_ids(known.where("quality = 0"), sample)
    mixed = sample_ids(known, sample)
    any_text = sample_ids(docs.where(usable & F.col("doc_id").isNotNull()), sample)
    role = [(r["doc_id"], k) for k, d in enumerate((good, bad, mixed, any_text)) for r in d.select("doc_id").collect()]
    if not role:
        return None
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i,) for i in {i for i, _ in role}], T.StructType([docs.schema["doc_id"]]))
    found = {r["doc_id"]: np.frombuffer(r["x"], np.float32) for r in sampled_features(docs, ids)}
    sets: list[list] = [[], [], [], []]
    for i, k in role:
        if i in found:
            sets[k].append(i)
    if not sets[0] or not sets[3]:
        return None
    is_good, is_bad = set(sets[0]), set(sets[1])
    judged = [i for i in sets[2] if i in is_good or i in is_bad]
    take = lambda keys: np.array([found[i] for i in keys])
    folds = lambda keys: np.array([zlib.crc32(str(i).encode()) // 5 % FOLDS for i in keys])
    return fit(
        take(sets[0]), take(sets[3]), take(judged), np.array([int(i in is_good) for i in judged]),
        folds(sets[0]), folds(sets[3]))


def score_documents(docs: DataFrame, model: QualityModel | None, cut: float = CUT) -> DataFrame:
    """Struct ``row`` of all columns, score and predicted; without a model every score is 0.5.

    Null and empty texts get the score of a text without words; equal texts get equal
    scores, repeated rows and rows without an id one each; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(c).cast("string").alias(c) if c == "text" else c for c in names]).alias("row"))
    schema = T.StructType([packed.schema["row"]]).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            # the text is a view into the row
            for piece in B.pieces(pa.RecordBatch.from_arrays([rows, rows.field("text")], names=["row", "text"]), "text", ROWS):
                if shared.value is None:
                    score = np.full(piece.num_rows, 0.5)
                else:
                    score = shared.value.score(features(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(score)], names=["row", "score"])

    return packed.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))
