import numpy as np
import pytest

from panelrisk.llm import whitening


def table(spark, x, ids=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, 3)
            for i, v in zip(range(len(x)) if ids is None else ids, x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, n int, component int")


def brute(x):
    """Rows of the contract by plain NumPy, in long doubles where it matters."""
    x = np.floor(64 * np.array(x)).astype(np.int64) + 1_000_000
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(0)
    away = once - s / n
    e, u = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-e)[:16]
    e, u = e[order], u[:, order]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, dev, (x - s / n) @ u / np.sqrt(e), e / np.trace(away.T @ away / n)


def check(rows, x, ids):
    n, dev, white, share = brute(x)
    k = white.shape[1]
    assert len(rows) == len(x) * k
    at = {v: i for i, v in enumerate(ids)}
    found = np.zeros((len(x), k))
    for r in rows:
        i = at[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == dev[i] and abs(r["identity_error"]) < 1e-8
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-6)
        found[i, r["component"] - 1] = r["whitened"]
    sign = np.sign((found * white).sum(0))
    assert np.abs(found * sign - white).max() < 1e-6


@pytest.mark.parametrize("d", [3, 16, 24])
def test_against_brute_force(spark, d):
    draw = np.random.default_rng(d)
    x = draw.normal(size=(400, d)) @ np.diag(np.geomspace(4, 0.05, d)) @ np.linalg.qr(draw.normal(size=(d, d)))[0]
    x[100:220] = x[7]  # one vector holds almost a third
    check(whitening.whiten(table(spark, x)).collect(), x, range(400))


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(30, 3)).tolist()
    odd = [None, [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("-inf"), 0.0], []]
    rows = whitening.whiten(table(spark, x + odd)).collect()
    check(rows, x, range(30))


def test_lengths_are_fitted_apart(spark):
    draw = np.random.default_rng(3)
    a, b = draw.normal(size=(40, 4)), draw.normal(size=(25, 2))
    rows = whitening.whiten(table(spark, a.tolist() + b.tolist())).collect()
    check([r for r in rows if r["vec_id"] < 40], a, range(40))
    check([r for r in rows if r["vec_id"] >= 40], b, range(40, 65))


def test_rank_and_tiny_tables(spark):
    draw = np.random.default_rng(5)
    a = draw.normal(size=(60, 2))
    x = np.concatenate([a, a[:, :1], np.ones((60, 1))], 1)  # a repeated and a constant column
    rows = whitening.whiten(table(spark, x)).collect()
    assert {r["component"] for r in rows} == {1, 2} and max(r["identity_error"] for r in rows) < 1e-9
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(table(spark, [])).count() == 0
    ids = [1, 1, None]
    assert sorted(r["vec_id"] is None for r in whitening.whiten(table(spark, [[0.0], [1.0], [2.0]], ids)).collect()) == [False, False, True]


def test_badly_scaled_columns_keep_their_identity(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(500, 4)) * np.array([1e7, 1e3, 1.0, 0.05])
    rows = whitening.whiten(table(spark, x)).collect()
    assert {r["component"] for r in rows} == {1, 2, 3, 4} and max(r["identity_error"] for r in rows) < 1e-6
    dev = {r["vec_id"]: r["deviation"] for r in rows}
    n, exact, _, _ = brute(x)
    assert all(dev[i] == (v if v < 1 << 63 else None) for i, v in enumerate(exact))


def test_products_are_exact():
    draw = np.random.default_rng(4)
    for size in (30, 1 << 19, 1 << 44):
        d = draw.integers(-size, size, (50, 3))
        exact = d.astype(object)
        assert (whitening.exact_products(d) == exact.T.dot(exact)).all()


def test_jacobi_on_a_factor():
    draw = np.random.default_rng(6)
    a = draw.normal(size=(33, 33)) * np.geomspace(1, 1e-6, 33)
    a = a @ a.T
    norm, u = whitening.jacobi(whitening.pivoted_cholesky(a))
    assert np.allclose(norm ** 2, np.linalg.eigvalsh(a)[::-1], rtol=1e-9, atol=1e-14)
    assert np.abs((u.T * norm ** 2) @ u - a).max() < 1e-14 * np.abs(a).max() * 33
    assert np.abs(u @ u.T - np.eye(33)).max() < 1e-12
