"""Exact neighbours against brute force, with crowded cells and tiny blocks."""

import numpy as np
import pytest

from panelrisk.ml import neighbors
from panelrisk.ml.neighbors import knn_regress, nearest, without_self


def brute(query, train, k):
    out = {}
    for qi, q in query:
        d = sorted((float(np.sqrt(((np.array(q) - np.array(t)) ** 2).sum())), ti) for ti, t in train)
        out[qi] = d[:k]
    return out


def points(n, dims, seed, start=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = [1.0] * dims  # a third of all rows share one place
        elif i % 3 == 1:
            v = list(map(float, rng.normal(size=dims)))
        else:
            v = list(map(float, np.round(rng.normal(size=dims) * 2) + 5))
        rows.append((start + i, v))
    return rows


@pytest.mark.parametrize("block,pivots", [(7, 5), (4096, 1024), (50, 1)])
def test_matches_brute_force(spark, block, pivots):
    train, query = points(240, 3, 1), points(60, 3, 2, 1000)
    t = spark.createDataFrame(train, "id long, vec array<double>")
    q = spark.createDataFrame(query, "id long, vec array<double>")
    near = nearest(q, t, "vec", ["id"], ["id"], 4, train_block=block, query_block=block,
                   max_pivots=pivots).collect()
    want = brute(query, train, 4)
    got = {}
    for r in sorted(near, key=lambda r: r["ordem"]):
        got.setdefault(r["id"], []).append((r["distancia"], r["viz_id"]))
    assert got.keys() == want.keys()
    for k, pairs in want.items():
        assert [i for _, i in got[k]] == [i for _, i in pairs]
        assert np.allclose([d for d, _ in got[k]], [d for d, _ in pairs], atol=1e-9)


def test_fewer_points_than_k(spark):
    t = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id long, vec array<double>")
    assert nearest(t, t, "vec", ["id"], ["id"], 5).count() == 4
    assert without_self(nearest(t, t, "vec", ["id"], ["id"], 2), ["id"], 1).count() == 2


def test_zero_distance_takes_only_exact_matches(spark):
    t = spark.createDataFrame([(1, [0.0], 10.0), (2, [0.0], 20.0), (3, [1.0], 90.0)],
                              "id long, vec array<double>, y double")
    q = spark.createDataFrame([(7, [0.0]), (8, [3.0])], "id long, vec array<double>")
    got = {r["id"]: r["pred"] for r in
           knn_regress(q, t, "vec", ["id"], ["id"], "y", 3).collect()}
    assert got[7] == pytest.approx(15.0)
    assert got[8] == pytest.approx((10 / 3 + 20 / 3 + 90 / 2) / (2 / 3 + 1 / 2))
    even = knn_regress(q, t, "vec", ["id"], ["id"], "y", 3, "uniform").collect()
    assert all(r["pred"] == pytest.approx(40.0) for r in even)


def test_far_queries_visit_few_leaves(spark):
    # a column in which all queries lie far from all points says nothing about which points are near
    rng = np.random.default_rng(3)
    points = np.hstack([np.zeros((4000, 1)), rng.normal(size=(4000, 3))])
    queries = np.hstack([np.full((400, 1), 9.0), rng.normal(size=(400, 3))])
    tree = neighbors._Tree(points[:1000], 64)
    t = spark.createDataFrame([(v.tolist(),) for v in points], "_t array<double>")
    low, high = neighbors._boxes(neighbors._placed(t, "_t", tree), tree.leaves, 4)
    want = np.sort(np.linalg.norm(queries[:, None] - points[None], axis=2), axis=1)[:, 4]
    asked = spark.createDataFrame([(v.tolist(), float(b)) for v, b in zip(queries, want)], "_q array<double>, _bound double")
    homed = neighbors._placed(asked, "_q", tree)
    assert tree.leaves == 64 and neighbors._visits(homed, low, high).count() < 400 * 12


def test_equal_queries_shifted_points_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    shift = 1e6  # squares lose most digits here
    train = [(i, (shift + rng.integers(0, 9, 3) / 8).tolist()) for i in range(300)]
    query = [(i, train[i % 7][1]) for i in range(50)]
    odd = [(900, None), (901, [1.0, None, 2.0]), (902, [1.0, float("nan"), 2.0]), (903, [1.0, float("inf"), 2.0])]
    t = spark.createDataFrame(train + odd, "id long, vec array<double>")
    q = spark.createDataFrame(query + odd, "id long, vec array<double>")
    want = {(i, p + 1, j) for i, d in brute(query, train, 6).items() for p, (_, j) in enumerate(d)}
    for block in (20, 4096):
        near = nearest(q, t, "vec", ["id"], ["id"], 6, train_block=block, query_block=5).collect()
        assert {(r["id"], r["ordem"], r["viz_id"]) for r in near} == want and len(near) == 300
