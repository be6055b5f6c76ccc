"""Exact nearest neighbours without a cross join.

Equal vectors are searched once, on both sides. Training vectors are cut into the
leaves of a k-d tree over a bounded sample; each leaf has the box of what it holds.
A query is compared with its own leaf first, then with the leaves whose box is not
farther than the k nearest found there. Leaves and their visitors are cut into
blocks of bounded size; a task sees one pair of blocks and returns at most k rows
per query, so neither a crowded leaf nor a popular query group lands in one task
and pairs are never emitted.

Inside a task matrix products say which points can be among the nearest; only
their distances are computed from differences, so that equal points give zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from panelrisk.storage import materialize

TRAIN_BLOCK = 8192
QUERY_BLOCK = 8192
MAX_PIVOTS = 1024
SAMPLED = 16  # sampled vectors for each leaf of the tree
CHUNK_CELLS = 4_000_000  # numbers held at once while computing distances
SLACK = 1e-9  # rounding must not lose a leaf


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in s])


def _usable(vec: str) -> Column:
    """No null, NaN or infinity in the vector."""
    return F.col(vec).isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


class _Tree:
    """Median splits along the widest column of a sample; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.column, self.cut, self.low, self.high, self.leaf = [], [], [], [], []
        self.leaves = 0
        self._grow(sample, leaves)
        self.column, self.low, self.high, self.leaf = (
            np.array(x) for x in (self.column, self.low, self.high, self.leaf))
        self.cut = np.array(self.cut)

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        node = len(self.column)
        for table, v in ((self.column, 0), (self.cut, 0.0), (self.low, 0), (self.high, 0), (self.leaf, -1)):
            table.append(v)
        spread = sample.max(axis=0) - sample.min(axis=0) if len(sample) else np.zeros(1)
        if leaves < 2 or not spread.size or spread.max() == 0:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        column = int(np.argmax(sample.var(axis=0) * (spread > 0)))
        values = np.sort(sample[:, column])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:  # the right side must keep something
            cut = values[values < cut][-1]
        left = sample[:, column] <= cut
        self.column[node], self.cut[node] = column, cut
        self.low[node] = self._grow(sample[left], leaves // 2)
        self.high[node] = self._grow(sample[~left], leaves - leaves // 2)
        return node

    def place(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), dtype=int)
        rows = np.arange(len(points))
        while True:
            inner = self.leaf[at] < 0
            if not inner.any():
                return self.leaf[at].astype("int32")
            left = points[rows, self.column[at]] <= self.cut[at]
            at = np.where(inner, np.where(left, self.low[at], self.high[at]), at)


def _placed(rows: DataFrame, vec: str, tree: _Tree) -> DataFrame:
    schema = StructType([*rows.schema.fields, StructField("_cell", IntegerType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(_cell=tree.place(_matrix(batch[vec])))

    return rows.mapInPandas(place, schema)


def _boxes(placed: DataFrame, cells: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of every column in every leaf; an empty leaf is nowhere."""
    schema = "_cell int, low array<double>, high array<double>"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = np.full((cells, dims), np.inf), np.full((cells, dims), -np.inf)
        for batch in batches:
            if len(batch):
                cell, points = batch["_cell"].to_numpy(), _matrix(batch["_t"])
                order = np.argsort(cell, kind="stable")
                found, starts = np.unique(cell[order], return_index=True)
                low[found] = np.minimum(low[found], np.minimum.reduceat(points[order], starts))
                high[found] = np.maximum(high[found], np.maximum.reduceat(points[order], starts))
        held = np.flatnonzero((low <= high).all(axis=1))
        yield pd.DataFrame({"_cell": held.astype("int32"), "low": list(low[held]), "high": list(high[held])})

    rows = (
        placed.select("_cell", "_t").mapInPandas(partial, schema)
        .select("_cell", F.posexplode(F.arrays_zip("low", "high")).alias("at", "v"))
        .groupBy("_cell", "at").agg(F.min("v.low").alias("low"), F.max("v.high").alias("high")).collect()
    )  # two numbers per leaf and column
    low, high = np.full((cells, dims), np.inf), np.full((cells, dims), np.inf)
    for r in rows:
        low[r["_cell"], r["at"]], high[r["_cell"], r["at"]] = r["low"], r["high"]
    return low, high


def _visits(homed: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Each query with the further leaves whose box is within its bound."""
    schema = StructType([
        *homed.schema.fields, StructField("_visit", ArrayType(IntegerType())),
    ])
    used = np.flatnonzero(np.isfinite(low).all(axis=1))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, CHUNK_CELLS // max(1, len(used)))
        for batch in batches:
            for i in range(0, len(batch), step):
                part = batch.iloc[i:i + step]
                points, home = _matrix(part["_q"]), part["_cell"].to_numpy()
                reach = part["_bound"].to_numpy() * (1 + SLACK) + SLACK
                gap = np.zeros((len(points), len(used)))
                for c in range(points.shape[1]):
                    x = points[:, c, None]
                    gap += np.maximum(np.maximum(low[used, c] - x, x - high[used, c]), 0.0) ** 2
                near = (np.sqrt(gap) <= reach[:, None]) & (used[None, :] != home[:, None])
                yield part.assign(_visit=[used[row].astype("int32") for row in near])

    found = homed.mapInPandas(choose, schema)
    return found.withColumn("_cell", F.explode("_visit")).drop("_visit")


def _closest(
    queries: np.ndarray, bounds: np.ndarray, points: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the k nearest points of each query that are within its bound.

    Ties go to the point that comes first. Squared distances from matrix products are
    off by no more than ``loose``, which keeps every point that could be among the k.
    """
    centre = points.mean(axis=0)
    a, b = queries - centre, points - centre
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    unit = 8 * (points.shape[1] + 8) * np.finfo(float).eps
    step = max(1, CHUNK_CELLS // max(1, len(points)))
    out = []
    for i in range(0, len(queries), step):
        far = a[i:i + step] @ b.T
        far *= -2
        far += bb[None, :]
        own = aa[i:i + step, None]
        loose = unit * (own + bb.max())
        limit = (bounds[i:i + step, None] * (1 + SLACK) + SLACK) ** 2 - own + loose
        keep = far <= limit
        crowded = np.flatnonzero(keep.sum(axis=1) > 2 * k)
        if len(crowded) and len(points) > k:
            part = far[crowded]
            kth = np.partition(part, k - 1, axis=1)[:, k - 1, None]
            keep[crowded] &= part <= kth + 2 * loose[crowded]
        row, col = np.nonzero(keep)
        size = max(1, CHUNK_CELLS // max(1, points.shape[1]))
        d = np.empty(len(row))
        for j in range(0, len(row), size):
            gap = queries[i + row[j:j + size]] - points[col[j:j + size]]
            d[j:j + size] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        order = np.lexsort((col, d, row))
        row, col, d = row[order], col[order], d[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < k
        out.append((row[top] + i, col[top], d[top]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _compared(
    visits: DataFrame, placed: DataFrame, sizes: dict[int, int], order: Sequence[str], k: int,
    train_block: int, query_block: int,
) -> DataFrame:
    """(_u, _v, distancia and the ordering ids) of the nearest points of each query in each visited block."""
    spark = placed.sparkSession
    visitors = {
        r["_cell"]: r["n"]
        for r in visits.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    blocks = spark.createDataFrame(
        [(c, math.ceil(m / train_block), math.ceil(visitors.get(c, 0) / query_block))
         for c, m in sizes.items()],
        "_cell int, _tb int, _qb int",
    )  # at most max_pivots rows

    def others(n_col):
        return F.explode(F.sequence(F.lit(0), F.col(n_col) - 1))

    t_side = (
        placed.join(F.broadcast(blocks), "_cell").where(F.col("_qb") > 0)
        .withColumn("_i", F.pmod(F.xxhash64("_v"), F.col("_tb")).cast("int"))
        .withColumn("_j", others("_qb"))
        .drop("_tb", "_qb")
    )
    q_side = (
        visits.join(F.broadcast(blocks), "_cell")
        .withColumn("_j", F.pmod(F.xxhash64("_u"), F.col("_qb")).cast("int"))
        .withColumn("_i", others("_tb"))
        .drop("_tb", "_qb")
    )
    fields = [
        StructField("_u", LongType()), StructField("distancia", DoubleType()), StructField("_v", LongType()),
        *[f for f in placed.schema.fields if f.name in order],
    ]
    names = [f.name for f in fields]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        right = right.sort_values(list(order), kind="stable", ignore_index=True)
        row, col, d = _closest(_matrix(left["_q"]), left["_bound"].to_numpy(), _matrix(right["_t"]), k)
        hits = right[["_v", *order]].iloc[col].reset_index(drop=True)
        return hits.assign(_u=left["_u"].to_numpy()[row], distancia=d)[names]

    keys = ["_cell", "_i", "_j"]
    return q_side.groupBy(*keys).cogroup(t_side.groupBy(*keys)).applyInPandas(best, StructType(fields))


def nearest(
    query: DataFrame,
    train: DataFrame,
    vec: str,
    query_ids: Sequence[str],
    train_ids: Sequence[str],
    k: int,
    carry: Sequence[str] = (),
    train_block: int = TRAIN_BLOCK,
    query_block: int = QUERY_BLOCK,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """The k nearest training rows of every query row, ties to the smallest ids.

    Returns the query ids, ``ordem``, ``distancia`` and the training ids and
    carried columns with prefix ``viz_``. ``max_pivots`` is the largest number of
    leaves. Rows whose vector is null or holds null, NaN or infinity take no part.
    """
    keep = list(dict.fromkeys([*train_ids, *carry]))
    t_ids = [f"viz_{c}" for c in train_ids]
    q_ids = [f"q_{c}" for c in query_ids]
    q = query.where(_usable(vec)).select(*[F.col(c).alias(f"q_{c}") for c in query_ids], F.col(vec).alias("_q"))
    t = train.where(_usable(vec)).select(*[F.col(c).alias(f"viz_{c}") for c in keep], F.col(vec).alias("_t"))

    # more than k equal points are never needed; the limit is applied before the shuffle
    same = Window.partitionBy("_t").orderBy(*t_ids)
    t = materialize(
        t.withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= k), "points")
    # one row per vector, with the ids of its first copy; the numbers are stored, so they stay
    points = materialize(
        t.where("_same = 1").select("_t", *t_ids, F.monotonically_increasing_id().alias("_v")), "vectors")
    n = points.count()
    if n == 0:
        raise ValueError("no training rows")
    q = materialize(q, "queries")
    asked = materialize(
        q.select("_q").distinct().withColumn("_u", F.monotonically_increasing_id()), "asked")

    cells = max(1, min(max_pivots, math.ceil(n / train_block)))
    if cells > 1:
        sample = points.select("_t").orderBy(F.xxhash64("_t"), "_t").limit(cells * SAMPLED).collect()
        tree = _Tree(np.array([r["_t"] for r in sample], dtype=float), cells)  # at most max_pivots leaves
        placed = materialize(_placed(points, "_t", tree), "cells")
        homed = materialize(_placed(asked, "_q", tree), "homes")
    else:
        tree = None
        placed, homed = points.withColumn("_cell", F.lit(0)), asked.withColumn("_cell", F.lit(0))
    sizes = {r["_cell"]: r["n"] for r in placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def compared(visits: DataFrame) -> DataFrame:
        return _compared(visits, placed, sizes, t_ids, k, train_block, query_block)

    first = Window.partitionBy("_u").orderBy("distancia", *t_ids)

    def ranked(near: DataFrame) -> DataFrame:
        return near.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= k)

    everywhere = F.lit(float("inf"))
    near = compared(homed.withColumn("_bound", everywhere))
    if tree is not None:
        near = materialize(ranked(near).drop("_rank"), "home")
        bound = near.groupBy("_u").agg(F.count(F.lit(1)).alias("_n"), F.max("distancia").alias("_far"))
        bounded = homed.join(bound, "_u", "left").select(
            "_u", "_q", "_cell", F.when(F.col("_n") >= k, F.col("_far")).otherwise(everywhere).alias("_bound"))
        low, high = _boxes(placed, tree.leaves, len(sample[0]["_t"]))
        visits = materialize(_visits(bounded, low, high), "visits")
        near = near.unionByName(compared(visits))
    found = ranked(near).select("_u", "distancia", "_v")

    # the copies of the vectors found, then the rows that asked for them
    copies = t.join(points.select("_t", "_v"), "_t").drop("_t", "_same")
    every = ranked(found.join(copies, "_v")).withColumnRenamed("_rank", "ordem")
    rows = q.join(asked, "_q").drop("_q")
    return rows.join(every, "_u").withColumnsRenamed({f"q_{c}": c for c in query_ids}).select(
        *query_ids, "ordem", "distancia", *[f"viz_{c}" for c in keep]
    )


def without_self(near: DataFrame, ids: Sequence[str], k: int) -> DataFrame:
    """Drop the row itself from k + 1 neighbours and number the rest."""
    same = F.lit(True)
    for c in ids:
        same = same & (F.col(c) == F.col(f"viz_{c}"))
    # at most k + 1 rows per query
    w = Window.partitionBy(*ids).orderBy("ordem")
    return near.where(~same).withColumn("ordem", F.row_number().over(w)).where(F.col("ordem") <= k)


def knn_regress(
    query: DataFrame, train: DataFrame, vec: str, query_ids: Sequence[str],
    train_ids: Sequence[str], target: str, k: int = 5, weights: str = "distance",
) -> DataFrame:
    """Mean target of the neighbours, by inverse distance or equal weights."""
    near = nearest(query, train, vec, query_ids, train_ids, k, [target])
    return neighbour_mean(near, query_ids, target, weights)


def neighbour_mean(
    near: DataFrame, query_ids: Sequence[str], target: str, weights: str = "distance",
) -> DataFrame:
    """Mean of the neighbours' target; where a neighbour is at distance zero, only such neighbours count."""
    d, y = F.col("distancia"), F.col(f"viz_{target}")
    if weights == "uniform":
        value = F.avg(y)
    else:
        exact = F.avg(F.when(d == 0, y))
        value = F.coalesce(
            exact, F.sum(F.try_divide(y, d)) / F.sum(F.try_divide(F.lit(1.0), d))
        )
    return near.groupBy(*query_ids).agg(value.alias("pred"))


def knn_profile(near: DataFrame, anchors: DataFrame, ids: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Mean of the neighbours next to the query's own values."""
    means = near.groupBy(*ids).agg(*[F.avg(f"viz_{c}").alias(f"media_{c}") for c in columns])
    return anchors.select(*ids, *columns).join(means, list(ids))
