import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelrisk.llm import neighbours


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], 1, 2) for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int, at int")


def brute(x, query, k):
    x = np.array(x, np.float32).astype(np.float64)
    score = x @ x[query]
    return [int(j) for j in np.lexsort((np.arange(len(x)), -score)) if j != query][:k]


def test_recall_over_several_blocks(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(1500, 24))
    rows = neighbours.nearest(table(spark, x), F.col("vec_id") % 50 == 0, k=20, beam=120, block=600).collect()
    hits = sum(r["vec_id"] in brute(x, r["query_id"], 20) for r in rows)
    assert len(rows) == 30 * 20 and hits / len(rows) >= 0.9
    exact = np.array(x, np.float32).astype(float)
    for r in rows:
        assert abs(r["score"] - exact[r["query_id"]] @ exact[r["vec_id"]]) < 1e-9


def test_copies_ties_and_unusable_vectors(spark):
    x = [[1.0, 0.0]] * 40 + [[0.0, 1.0], [0.0, 0.0], [float("nan"), 1.0], [None, 1.0], None, [float("inf"), 1.0], [1.0]]
    rows = neighbours.nearest(table(spark, x), F.col("vec_id").isin(3, 40, 41, 42, 43, 44, 45, 46), k=5).collect()
    found = {q: [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (3, 40)}
    assert found == {3: [0, 1, 2, 4, 5], 40: [0, 1, 2, 3, 4]} and {r["query_id"] for r in rows} == {3, 40}


def test_lengths_do_not_meet(spark):
    draw = np.random.default_rng(5)
    x = [*draw.normal(size=(60, 4)).tolist(), *draw.normal(size=(9, 3)).tolist(), [1.0] * 7]
    rows = neighbours.nearest(table(spark, x), F.lit(True), k=20).collect()
    for lo, hi in ((0, 60), (60, 69)):
        for q in range(lo, hi):
            found = [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q]
            assert found == [lo + i for i in brute(x[lo:hi], q - lo, 20)]
    assert len(rows) == 60 * 20 + 9 * 8


def test_few_and_no_candidates(spark):
    rows = neighbours.nearest(table(spark, [[1.0, 2.0], [3.0, 1.0], [2.0, 2.0]]), F.lit(True), k=20).collect()
    assert len(rows) == 6
    assert neighbours.nearest(table(spark, []), F.lit(True)).count() == 0
    assert neighbours.nearest(table(spark, [[1.0, 2.0]]), F.lit(True)).count() == 0


def test_recall_in_tight_groups(spark):
    """Groups with more near copies than links, in one block, from the first graph and from the built one."""
    draw = np.random.default_rng(7)
    for size in (25, 40, 100):
        centres = draw.normal(size=(2000 // size, 32))
        x = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], size, 0)
        x = x + draw.normal(size=x.shape) * 0.01
        x = np.array(x[draw.permutation(len(x))], np.float32).astype(float)
        rows = pd.DataFrame({"block": 0, "place": np.arange(len(x)), "vec": list(x)})
        links = neighbours._links(neighbours._started(rows, 20)["near"].tolist(), len(x), 20)
        hits, asked = 0, x[::50]
        entries = neighbours._components(links)
        for i, around in zip(range(0, len(x), 50), neighbours.Cells(x).around(asked)):
            ids, _ = neighbours.greedy_search(x, links, x[i], 21, 240, np.concatenate([entries, around]))
            hits += len(set(ids) & set(brute(x, i, 20)))
        assert hits / (20 * len(asked)) >= 0.9
    found = neighbours.nearest(table(spark, x), F.col("vec_id") % 50 == 0, k=20).collect()
    assert sum(r["vec_id"] in brute(x, r["query_id"], 20) for r in found) / (20 * len(asked)) >= 0.9


def test_own_links_are_never_cut():
    near = [[299, 300, 301], *[[0, i - 1] for i in range(1, 302)]]  # all point to node 0
    links = neighbours._links(near, len(near), 3)
    assert all(set(row) <= set(links[i].tolist()) for i, row in enumerate(near))
