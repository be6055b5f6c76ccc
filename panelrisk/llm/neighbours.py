"""Approximate nearest neighbours by inner product: NN-descent graphs and greedy search.

Equal vectors are one node. Nodes are dealt to blocks of about ``BLOCK`` by hash.
Each block gets a neighbour graph: from random neighbours and those in the same
cell of ``TREES`` random-projection trees, every round joins the sampled lists of
neighbours (and of reverse neighbours) with themselves, so that each node meets the
neighbours of its neighbours, and keeps the best. A query walks the graph of every
block greedily with a list of the ``BEAM`` best nodes; it enters at the cells it
falls into, which hold its own node, at one node of every component of the graph and
at some fixed nodes. The best of all blocks are merged. Scores are exact, membership
is approximate.

``BEAM`` sets the recall. Memory of a task is one block and ``QUERIES`` queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelrisk.llm.scratch import Scratch

BLOCK = 8192
DEGREE = 20
SAMPLE = 10   # neighbours, and reverse neighbours, that a round looks through
ROUNDS = 6
BEAM = 240
STEP = 6      # nodes opened at once
QUERIES = 1024
TREES = 6
LEAF = 32     # most nodes of a cell, but for equal projections


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """(vec, copies): distinct vectors with the k + 1 smallest ids that carry each.

    More copies than that can never be among the k nearest of anything.
    """
    # 0.0 and -0.0 are one value to an inner product
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    valid = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", v.alias("vec")).where(_usable(F.col("vec")))
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    return (
        valid.distinct().withColumn("_r", rank).where(F.col("_r") <= k + 1)
        .groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("copies"))
    )


def _blocks(nodes: DataFrame, scratch: Scratch, block: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(block, at, vec, copies) with ``at`` counting from 0 in each block, and the first block and number per length.

    Vectors of one length only meet each other: no block holds two lengths.
    """
    stored = scratch.write(nodes, "nodes")
    spans, first = {}, 0
    for length, n in stored.groupBy(F.size("vec")).count().orderBy(F.size("vec")).collect():  # a row per length
        spans[length] = (first, -(-n // block))
        first += spans[length][1]
    h = F.xxhash64(F.col("copies")[0])
    placed = stored.withColumn("block", (_by_length(spans, 0) + F.pmod(h, _by_length(spans, 1))).cast("int"))
    order = Window.partitionBy("block").orderBy(F.col("copies")[0])  # about ``block`` rows each
    return scratch.write(placed.withColumn("at", F.row_number().over(order) - 1), "blocks"), spans


def _by_length(spans: dict[int, tuple[int, int]], part: int) -> Column:
    """First block (0) or number of blocks (1) for the length of ``vec``; null for another length."""
    pairs = [F.lit(v) for length, span in spans.items() for v in (length, span[part])]
    return F.create_map(*pairs)[F.size("vec")] if pairs else F.lit(None).cast("int")


def _best(u: np.ndarray, lists: list, x: np.ndarray, degree: int) -> list:
    out = []
    for i, near in zip(u, lists):
        near = np.unique(np.asarray(near, np.int64))
        near = near[near != i]
        score = x[near] @ x[i]
        out.append(near[np.argsort(-score, kind="stable")[:degree]].tolist())
    return out


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    rows = rows.sort_values("place")
    return np.array(rows["vec"].tolist(), np.float64)


def _improved(candidates: DataFrame, blocks: DataFrame, degree: int) -> DataFrame:
    """(block, at, near): the best of each node's candidates."""

    def score(found: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(found):
            return pd.DataFrame({"block": [], "at": [], "near": []})
        near = _best(found["at"].to_numpy(), found["near"].tolist(), _matrix(rows), degree)
        return pd.DataFrame({"block": found["block"], "at": found["at"], "near": near})

    rows = blocks.select(F.col("block").alias("own"), F.col("at").alias("place"), "vec")
    return candidates.groupBy("block").cogroup(rows.groupBy("own")).applyInPandas(
        score, "block int, at int, near array<int>")


class Cells:
    """Cells of random-projection trees over directions, each cut at medians down to ``leaf`` nodes."""

    def __init__(self, x: np.ndarray, trees: int = TREES, leaf: int = LEAF):
        self.depth = max(0, int(np.ceil(np.log2(max(len(x), 1) / leaf))))
        draw = np.random.default_rng(20240611)
        self.trees = []
        for _ in range(trees):
            planes = draw.normal(size=(x.shape[1], self.depth))
            along = _directions(x) @ planes
            code, cuts = np.zeros(len(x), np.int64), []
            for d in range(self.depth):
                order = np.lexsort((along[:, d], code))
                count = np.bincount(code, minlength=1 << d)
                middle = np.minimum(np.cumsum(count) - count + count // 2, len(x) - 1)
                cuts.append(along[order[middle], d])
                code = code * 2 + (along[:, d] >= cuts[-1][code])
            order = np.argsort(code, kind="stable")
            self.trees.append((planes, cuts, order, np.searchsorted(code[order], np.arange((1 << self.depth) + 1))))

    def members(self) -> list[np.ndarray]:
        """The nodes of every cell."""
        return [order[a:b] for _, _, order, first in self.trees for a, b in zip(first[:-1], first[1:])]

    def around(self, q: np.ndarray) -> list[np.ndarray]:
        """For each row of q the nodes of the cells it falls into."""
        out: list[list] = [[] for _ in q]
        for planes, cuts, order, first in self.trees:
            along = _directions(q) @ planes
            code = np.zeros(len(q), np.int64)
            for d, cut in enumerate(cuts):
                code = code * 2 + (along[:, d] >= cut[code])
            for near, c in zip(out, code):
                near.append(order[first[c]:first[c + 1]])
        return [np.concatenate(near) for near in out]


def _directions(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


def _started(rows: pd.DataFrame, degree: int) -> pd.DataFrame:
    """(block, at, near): the best of random nodes and of those in the same cells."""
    x = _matrix(rows)
    draw = np.random.default_rng(int(rows["block"].iloc[0]))
    near = [[r] for r in draw.integers(0, len(x), (len(x), degree))]
    for cell in Cells(x).members():
        for i in cell:
            near[i].append(cell)
    near = _best(np.arange(len(x)), [np.concatenate(v) for v in near], x, degree)
    return pd.DataFrame({"block": rows["block"].iloc[0], "at": np.arange(len(x)), "near": near})


def build_graph(
    blocks: DataFrame, scratch: Scratch, degree: int = DEGREE, sample: int = SAMPLE, rounds: int = ROUNDS
) -> DataFrame:
    """(block, at, near) after ``rounds`` rounds of joins of neighbours of neighbours."""
    start = blocks.select("block", F.col("at").alias("place"), "vec").groupBy("block").applyInPandas(
        lambda rows: _started(rows, degree), "block int, at int, near array<int>")
    graph = scratch.write(start, "graph-0")
    for turn in range(rounds):
        def some(near: str) -> Column:  # a sample in hash order, another one each round
            mixed = F.array_sort(F.transform(near, lambda v: F.struct(F.xxhash64(F.lit(turn), "at", v), v.alias("v"))))
            return F.slice(F.transform(mixed, lambda s: s["v"]), 1, sample)

        ahead = graph.select("block", "at", some("near").alias("near"))
        arrows = ahead.select("block", "at", F.explode("near").alias("to"))
        back = arrows.withColumnRenamed("at", "_from").groupBy("block", F.col("to").alias("at")).agg(
            F.collect_list("_from").alias("near"))
        back = back.select("block", "at", some("near").alias("back"))
        lists = ahead.join(back, ["block", "at"], "left").select(
            "block", "at", F.array_union("near", F.coalesce("back", F.array().cast("array<int>"))).alias("near"))
        lists = scratch.write(lists, f"lists-{turn}")
        step = lists.select("block", F.col("at").alias("_from"), F.explode("near").alias("at"))
        met = step.join(lists, ["block", "at"]).groupBy("block", F.col("_from").alias("at")).agg(
            F.flatten(F.collect_list("near")).alias("met"))
        candidates = graph.join(met, ["block", "at"], "left").select(
            "block", "at", F.array_union("near", F.coalesce("met", F.array().cast("array<int>"))).alias("near"))
        graph = scratch.write(_improved(candidates, blocks, degree), f"graph-{turn + 1}")
        scratch.drop(f"graph-{turn}", f"lists-{turn}")
    return graph


def _links(near: list, n: int, degree: int) -> np.ndarray:
    """All neighbours and then reverse neighbours of each node, -1 where there are no more."""
    source = np.repeat(np.arange(n), [len(v) for v in near])
    target = np.fromiter((v for row in near for v in row), np.int64, len(source))
    code = np.concatenate([source * n + target, target * n + source])
    code, one = np.unique(code, return_index=True)  # the first place of a pair is that of the neighbour
    u, v, reverse = code // n, code % n, one >= len(source)
    order = np.lexsort((v, reverse, u))
    u, v = u[order], v[order]
    first = np.searchsorted(u, np.arange(n + 1))
    width = 3 * max(degree, max(map(len, near), default=0))
    place = np.arange(len(u)) - first[u]
    out = np.full((n, width), -1, np.int64)
    kept = place < width
    out[u[kept], place[kept]] = v[kept]
    return out


def _components(links: np.ndarray) -> np.ndarray:
    """One node of every component of the graph."""
    n = len(links)
    u = np.repeat(np.arange(n), (links >= 0).sum(1))
    v = links[links >= 0]
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return np.unique(label)
        label = new


def greedy_search(
    x: np.ndarray, links: np.ndarray, q: np.ndarray, k: int, beam: int, entries: np.ndarray, step: int = STEP
):
    """Places and scores of the k best nodes that a walk from the entries finds."""
    n = len(x)
    entries = np.arange(n) if n <= beam else np.unique(entries)
    seen = np.zeros(n, bool)
    seen[entries] = True
    ids, score = entries, x[entries] @ q
    opened = np.zeros(len(ids), bool)
    while True:
        order = np.argsort(-score, kind="stable")[:beam]
        ids, score, opened = ids[order], score[order], opened[order]
        todo = np.flatnonzero(~opened)[:step]
        if not len(todo):
            return ids[:k], score[:k]
        opened[todo] = True
        new = links[ids[todo]].ravel()
        new = new[new >= 0]
        new = np.unique(new[~seen[new]])
        seen[new] = True
        ids = np.concatenate([ids, new])
        score = np.concatenate([score, x[new] @ q])
        opened = np.concatenate([opened, np.zeros(len(new), bool)])


def search(
    blocks: DataFrame, graph: DataFrame, queries: DataFrame, spans: dict[int, tuple[int, int]], k: int, beam: int = BEAM,
    chunk: int = QUERIES, degree: int = DEGREE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, ties to the smaller id."""
    chunks = max(1, -(-queries.count() // chunk))
    first, count = _by_length(spans, 0), _by_length(spans, 1)
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(first, first + count - 1)))
    index = blocks.join(graph, ["block", "at"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def walk(part: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(part) or not len(rows):
            return empty
        rows = rows.sort_values("at")
        x = np.array(rows["vec"].tolist(), np.float64)
        copies = rows["copies"].tolist()
        links = _links([list(v) for v in rows["near"]], len(x), degree)
        always = np.concatenate([_components(links), np.linspace(0, len(x) - 1, 48).astype(np.int64)])
        asked = np.array(part["vec"].tolist(), np.float64)
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        for query, q, around in zip(part["query_id"], asked, Cells(x).around(asked)):
            ids, score = greedy_search(x, links, q, k + 1, beam, np.concatenate([always, around]))
            for i, s in zip(ids, score):
                for c in copies[i]:
                    if c != query:
                        out["query_id"].append(query)
                        out["vec_id"].append(c)
                        out["score"].append(s)
        return pd.DataFrame(out) if out["query_id"] else empty

    found = asked.groupBy("block", "chunk").cogroup(index.groupBy("block", "chunk")).applyInPandas(
        walk, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """The k nearest other vectors of every row where ``is_query`` holds.

    Vectors that are null, zero or hold null or non-finite numbers take no part.
    Vectors of different lengths have no product: each finds those of its own length. Rows repeated with id and vector count
    once. Without a usable vector the result is empty. Only ``vec_id`` and
    ``embedding`` are read.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    blocks, spans = _blocks(nodes_of(vectors, k), scratch, block)
    graph = build_graph(blocks, scratch)
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    queries = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), v.alias("vec"))
    queries = queries.where(_usable(F.col("vec"))).distinct()
    return search(blocks, graph, scratch.write(queries, "queries"), spans, k, beam)
