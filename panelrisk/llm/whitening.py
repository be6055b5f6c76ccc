"""Whitening of embeddings: exact scatter, pivoted Cholesky, one-sided Jacobi on the factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.llm.scratch import Scratch

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40  # entries beyond have no exact integer sums and count as not finite
ROWS = 4096  # rows multiplied at once
DIGIT = 20  # bits of one digit of an entry: products of ROWS rows stay exact in a double
COMPONENTS = 16
WHOLE = "decimal(38,0)"

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """Fit of the vectors of one length."""

    n: int
    sums: np.ndarray  # Python integers
    centre: np.ndarray  # integers next to the means
    offset: np.ndarray  # centre less mean
    axes: np.ndarray  # columns: components over the root of their eigenvalue
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) + self.offset) @ self.axes

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2, null where a long can't hold them."""
        near = x - self.centre
        left = np.array([self.n * int(c) - s for c, s in zip(self.centre, self.sums)], object)
        bound = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if bound * bound * max(1, x.shape[1]) < 1 << 63:
            away = self.n * near + left.astype(np.int64)
            return np.einsum("ij,ij->i", away, away).tolist()
        away = self.n * near.astype(object) + left
        return [v if v < 1 << 63 else None for v in (away * away).sum(1)]


def integers(vec: Column) -> Column:
    """floor(64 c) + 1000000 of every entry; null for vectors that take no part."""
    fine = F.forall(vec, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    whole = F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return F.when(vec.isNotNull() & fine, whole)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors of one length in a batch, ``ROWS`` at once."""
    x = batch.column("x")
    size = np.diff(x.offsets.to_numpy())
    flat, start = x.values.to_numpy(), x.offsets.to_numpy()[:-1]
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        for at in range(0, len(rows), ROWS):
            some = rows[at:at + ROWS]
            yield int(length), some, flat[start[some][:, None] + np.arange(length)]


def exact_products(d: np.ndarray) -> np.ndarray:
    """d' d as Python integers: products of digits are exact in doubles."""
    digits, rest = [], d
    while True:
        if np.all(np.abs(rest) < 1 << DIGIT):
            digits.append(rest.astype(np.float64))
            break
        digits.append((rest & ((1 << DIGIT) - 1)).astype(np.float64))
        rest = rest >> DIGIT
    out = np.zeros((d.shape[1], d.shape[1]), object)
    for i, a in enumerate(digits):
        for j, b in enumerate(digits):
            out += (a.T @ b).astype(np.int64).astype(object) * (1 << (DIGIT * (i + j)))
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for length, rows, x in by_length(batch):
            n, total = held.get(length, (0, np.zeros(length, object)))
            held[length] = n + len(rows), total + x.sum(0).astype(object)
    for length, (n, total) in held.items():
        yield pa.record_batch({
            "length": pa.array([length] * length, pa.int32()), "i": pa.array(range(length), pa.int32()),
            "n": pa.array([n] * length, pa.int64()),
            "total": pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))})


def _scatter(centres: dict[int, np.ndarray]):
    """Per task the sums of products of centred vectors (upper triangle) and of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in by_length(batch):
                found = exact_products(x - centres[length])
                held[length] = held[length] + found if length in held else found
        for length, total in held.items():
            i, j = np.triu_indices(length)
            for at in range(0, len(i), 1 << 16):
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                yield pa.record_batch({
                    "length": pa.array([length] * len(a), pa.int32()),
                    "i": pa.array(a, pa.int32()), "j": pa.array(b, pa.int32()),
                    "total": pa.array([Decimal(v) for v in total[a, b]], pa.decimal128(38, 0))})

    return run


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G with G G' = a for a positive semidefinite matrix, one column per rank, largest pivot first.

    Works in extended precision and stops where what is left is rounding.
    """
    a = np.array(a, np.longdouble)
    d = len(a)
    least = d * np.finfo(np.longdouble).eps * (np.diag(a).max(initial=0))
    left, order = np.diag(a).copy(), np.arange(d)
    g = np.zeros((d, 0), np.longdouble)
    columns = []
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        order[[k, p]] = order[[p, k]]
        at = order[k]
        if not left[at] > least:
            break
        column = np.zeros(d, np.longdouble)
        rest = order[k + 1:]
        root = np.sqrt(left[at])
        column[at] = root
        before = sum((c[rest] * c[at] for c in columns), np.zeros(len(rest), np.longdouble))
        column[rest] = (a[rest, at] - before) / root
        left[rest] -= column[rest] ** 2
        columns.append(column)
    if columns:
        g = np.stack(columns, 1)
    return g.astype(np.float64)


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Norms and unit directions of the columns of ``g`` rotated until they are orthogonal, by falling norm.

    Disjoint pairs of columns are rotated together, in the order of a round robin.
    """
    rows = np.ascontiguousarray(g.T)
    count = len(rows)
    players = list(range(count + count % 2))
    for _ in range(sweeps):
        rotated = False
        for _ in range(len(players) - 1):
            half = len(players) // 2
            pairs = [(a, b) for a, b in zip(players[:half], players[:half - 1:-1]) if a < count and b < count]
            players = [players[0], players[-1], *players[1:-1]]
            p, q = np.array(pairs, int).reshape(-1, 2).T
            x, y = rows[p], rows[q]
            a, b, c = (np.einsum("ij,ij->i", u, v) for u, v in ((x, x), (y, y), (x, y)))
            on = np.abs(c) > 1e-15 * np.sqrt(a * b)
            if not on.any():
                continue
            rotated = True
            p, q, x, y, a, b, c = p[on], q[on], x[on], y[on], a[on], b[on], c[on]
            zeta = (b - a) / (2 * c)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            rows[p], rows[q] = cos[:, None] * x - sin[:, None] * y, sin[:, None] * x + cos[:, None] * y
        if not rotated:
            break
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    order = np.argsort(-norm, kind="stable")
    return norm[order], rows[order] / norm[order, None]


def solve(n: int, sums: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> Whitening:
    """Components from the exact sums of one length (Python integers, centred at ``centre``)."""
    shift = sums - n * centre
    exact = n * scatter - np.outer(shift, shift)  # n^2 times the covariance
    largest = max((int(v) for v in np.diag(exact)), default=0)
    if not largest:
        return Whitening(n, sums, centre.astype(np.int64), np.zeros(len(sums)), np.zeros((len(sums), 0)), np.zeros(0))
    # long doubles from integers of any size, in two parts
    step = 1 << max(0, largest.bit_length() - 60)
    high = exact // step
    a = high.astype(np.int64).astype(np.longdouble) + (exact - high * step).astype(np.float64) / np.longdouble(step)
    norm, directions = jacobi(pivoted_cholesky(a))
    norm, directions = norm[:COMPONENTS], directions[:COMPONENTS]
    sign = np.sign(directions[np.arange(len(norm)), np.abs(directions).argmax(1)])
    trace = np.diag(a).sum()
    root = norm * float(np.sqrt(np.longdouble(step))) / n
    return Whitening(
        n, sums, centre.astype(np.int64),
        np.array([float(Fraction(int(n * c - s), n)) for c, s in zip(centre, sums)]),
        (directions * sign[:, None] / root[:, None]).T, (norm.astype(np.longdouble) ** 2 / trace).astype(np.float64))


def _identity_error(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest distance of the covariance of whitened vectors from the identity, per length."""

    def run(batches):
        held = {}
        for batch in batches:
            for length, _, x in by_length(batch):
                w = models[length].project(x)
                found = np.concatenate([w.sum(0)[None], w.T @ w])
                held[length] = held[length] + found if length in held else found
        for length, total in held.items():
            i, j = np.indices(total.shape)
            yield pa.record_batch({
                "length": pa.array([length] * total.size, pa.int32()), "i": pa.array(i.ravel(), pa.int32()),
                "j": pa.array(j.ravel(), pa.int32()), "total": pa.array(total.ravel(), pa.float64())})

    rows = fit.mapInArrow(run, "length int, i int, j int, total double").groupBy("length", "i", "j").agg(F.sum("total").alias("total"))
    found = {}
    for r in rows.collect():  # at most 17 x 16 per length
        k, n = models[r["length"]].axes.shape[1], models[r["length"]].n
        found.setdefault(r["length"], np.zeros((k + 1, k)))[r["i"], r["j"]] = r["total"] / n
    return {length: float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(m.shape[1])).max(initial=0)) for length, m in found.items()}


def fit(vectors: DataFrame) -> dict[int, Whitening]:
    """Whitening of every vector length from a table of integer vectors ``x``, each distinct one once.

    Sums and centred products are exact integers; the driver gets one triangle of
    products per length, whatever the number of rows.
    """
    fit_list = vectors.select("x").distinct()
    fit_list = Scratch(vectors.sparkSession, "whitening").write(fit_list, "fit")
    totals: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    rows = fit_list.mapInArrow(_sums, f"length int, i int, n long, total {WHOLE}").groupBy("length", "i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    for r in rows.collect():
        totals.setdefault(r["length"], np.zeros(r["length"], object))[r["i"]] = int(r["total"])
        count[r["length"]] = r["n"]
    centres = {length: np.array([(2 * int(s) + count[length]) // (2 * count[length]) for s in total], np.int64)
               for length, total in totals.items()}
    scatter = {length: np.zeros((length, length), object) for length in totals}
    rows = fit_list.where(F.size("x") > 0).mapInArrow(_scatter(centres), f"length int, i int, j int, total {WHOLE}").groupBy(
        "length", "i", "j").agg(F.sum("total").alias("total"))
    for r in rows.collect():
        scatter[r["length"]][r["i"], r["j"]] = scatter[r["length"]][r["j"], r["i"]] = int(r["total"])
    models = {length: solve(count[length], totals[length], centres[length].astype(object), scatter[length]) for length in totals}
    for length, error in _identity_error(fit_list.where(F.size("x") > 0), models).items():
        models[length].identity_error = error
    return models


def whiten(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Whitened components of every usable vector, one row per vector and component.

    Null vectors and those with null or non-finite entries (or entries of 2^40 and
    more) go. Each length of vector has its own fit. Components whose eigenvalue is
    zero can't be whitened and are left out, so equal vectors, a single one, empty
    ones and an empty table give no row. Copies count once in the fit and each get
    their rows, as do repeated and null ids. ``deviation`` is null where a long
    can't hold it. Other columns do not matter.
    """
    rows = vectors.select("vec_id", integers(F.col(vec)).alias("x")).where("x is not null")
    models = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").cast(pa.int64())
            for length, at, x in by_length(batch):
                model = models[length]
                k = model.axes.shape[1]
                again = np.repeat(at, k)
                yield pa.record_batch({
                    "vec_id": ids.take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                    "n": pa.array(np.full(len(again), model.n), pa.int64()),
                    "deviation": pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    "whitened": pa.array(model.project(x).ravel(), pa.float64()),
                    "explained": pa.array(np.tile(model.explained, len(at)), pa.float64()),
                    "identity_error": pa.array(np.full(len(again), model.identity_error), pa.float64())})

    return rows.where(F.size("x") > 0).mapInArrow(run, OUT)
