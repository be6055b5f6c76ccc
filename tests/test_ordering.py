"""Positions, ranks and quantiles against plain Python, with hot values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelrisk.operators import ordering
from panelrisk.operators.ordering import dense_rank_rows, number_rows, quantiles


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    # one value holds a third of all rows
    return [
        (i, rng.choice(["a", "b", "b", "b"]),
         7.5 if i % 3 == 0 else (None if i % 17 == 0 else round(rng.uniform(0, 20), 1)))
        for i in range(6000)
    ]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(8)


def test_number_rows_is_dense_and_ordered(table, rows):
    out = number_rows(table, ["v", "id"], "n").collect()
    got = [r["id"] for r in sorted(out, key=lambda r: r["n"])]
    assert sorted(r["n"] for r in out) == list(range(len(rows)))
    want = sorted(rows, key=lambda r: (r[2] is not None, r[2] if r[2] is not None else 0, r[0]))
    assert got == [r[0] for r in want]


def test_dense_rank_over_blocks(spark, table, rows):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = dense_rank_rows(table, "v", ["id"], "r").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    order = sorted({r[2] for r in rows if r[2] is not None}, reverse=True)
    place = {v: i + 1 for i, v in enumerate(order)} | {None: len(order) + 1}
    assert all(r["r"] == place[r["v"]] for r in out)
    assert len(out) == len(rows)


def test_quantiles_match_numpy(table, rows):
    probs, names = (0.0, 0.25, 0.5, 0.9, 1.0), ("p0", "p25", "p50", "p90", "p100")
    out = {r["g"]: r for r in quantiles(table, ["g"], "v", probs, names).collect()}
    for g in ("a", "b"):
        v = [r[2] for r in rows if r[1] == g and r[2] is not None]
        for p, n in zip(probs, names):
            assert out[g][n] == pytest.approx(np.percentile(v, 100 * p), abs=1e-9)


@pytest.mark.parametrize("limit", [1 << 22, 300, 1])
def test_quantiles_of_narrowed_groups(table, rows, monkeypatch, limit):
    """Groups larger than what is taken whole, in one scan and with further narrowing."""
    monkeypatch.setattr(ordering, "WHOLE", 40)
    monkeypatch.setattr(ordering, "ACCURACY", 200)
    table = table.withColumn("v", F.col("v") + F.col("id") % 13 / 100)
    found = {}
    for r in table.where("v is not null").collect():
        found.setdefault(r["g"], []).append(r["v"])
    probs, names = (0.0, 0.01, 0.333, 0.5, 0.99, 1.0), tuple("abcdef")
    for r in quantiles(table, ["g"], "v", probs, names, limit).collect():
        assert [r[n] for n in names] == pytest.approx(list(np.percentile(found[r["g"]], [100 * p for p in probs])), abs=1e-9)


@pytest.mark.parametrize("limit", [1 << 22, 1])
def test_quantiles_of_columns(table, rows, monkeypatch, limit):
    monkeypatch.setattr(ordering, "WHOLE", 40)
    monkeypatch.setattr(ordering, "ACCURACY", 200)
    wide = table.select("v", (F.col("id") * 37 % 1009).alias("w"), F.lit(None).cast("double").alias("e"), F.lit(2.5).alias("c"))
    probs, names = (0.0, 0.25, 0.77, 1.0), tuple("abcd")
    out = {r["indicator"]: [r[n] for n in names] for r in ordering.column_quantiles(wide, ["v", "w", "e", "c"], probs, names, limit).collect()}
    want = {"v": [r[2] for r in rows if r[2] is not None], "w": [r[0] * 37 % 1009 for r in rows], "c": [2.5]}
    assert out == {k: pytest.approx(list(np.percentile(v, [100 * p for p in probs])), abs=1e-9) for k, v in want.items()}
    assert ordering.column_quantiles(wide.select("e"), ["e"], probs, names).count() == 0


def test_quantiles_without_keys(table, rows):
    got = quantiles(table, [], "v", (0.5,), ("m",)).first()["m"]
    assert got == pytest.approx(np.median([r[2] for r in rows if r[2] is not None]))


def test_quantiles_of_nothing(table):
    assert quantiles(table.where("false"), ["g"], "v", (0.5,), ("m",)).count() == 0
    assert quantiles(table.where("false"), [], "v", (0.5,), ("m",)).count() == 0


def test_single_value(table):
    out = quantiles(table.where(F.col("v") == 7.5), ["g"], "v", (0.1, 0.9), ("a", "b"))
    assert {(r["a"], r["b"]) for r in out.collect()} == {(7.5, 7.5)}
