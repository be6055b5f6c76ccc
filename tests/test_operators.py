import numpy as np
import pytest
from pyspark.sql import functions as F

from panelrisk.operators import cleaning, integrate, quality, ranking, series, stats
from panelrisk.operators.joining import lookup_join


def rows_of(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_dedup_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2.0)], "a int, b double")
    assert cleaning.dedup_rows(df).count() == 2
    assert tuple(cleaning.duplicate_counts(df).first()) == (3, 2, 1)


def test_clean_rates(spark):
    df = spark.createDataFrame(
        [("2010", 1, "120", "x"), ("2010", 1, "120", "x"), ("2011", 1, "-2", "4.5")],
        "ano string, id long, taxa_a string, atu string",
    )
    out = cleaning.clean_rates(df, "ano", ["id"])
    assert dict(out.dtypes) == {"ano": "int", "id": "string", "taxa_a": "double", "atu": "double"}
    assert rows_of(out, "ano", "taxa_a", "atu") == [(2010, 100.0, None), (2011, 0.0, 4.5)]


def test_at_risk_null_is_false_and_last(spark):
    df = spark.createDataFrame(
        [(1, 10.0, None), (2, None, 5.0), (3, 9.9, 4.9), (4, None, None), (5, 30.0, 1.0)],
        "id int, a double, b double",
    )
    out = cleaning.at_risk(df, {"a": 10.0, "b": 5.0}, ["id"])
    assert [r["id"] for r in out.collect()] == [5, 1, 2]


def test_last_years_and_required_columns(spark):
    df = spark.createDataFrame([(2001,), (2003,), (2003,), (2008,)], "ano int")
    assert cleaning.last_n_years(df, 2).count() == 3
    with pytest.raises(ValueError, match="zz"):
        cleaning.require_columns(df, ["ano", "zz"])


def test_join_paths_agree_and_keys_must_be_unique(spark):
    left = spark.createDataFrame([(i, 2000 if i % 3 else 2000 + i % 7) for i in range(500)],
                                 "id int, ano int")
    right = spark.createDataFrame([(2000 + i, float(i)) for i in range(5)], "ano int, v double")
    for how in ("inner", "left"):
        wide = lookup_join(left, right, ["ano"], how)
        shuffled = lookup_join(left, right, ["ano"], how, max_bytes=0)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert rows_of(wide, "id", "ano", "v") == rows_of(shuffled, "id", "ano", "v")
    with pytest.raises(ValueError, match="not unique"):
        lookup_join(left, right.union(right), ["ano"])


def test_fact_drops_clashing_columns_and_missing_years(spark):
    fact = spark.createDataFrame([(1, 2010, 30.0, 9.0), (2, 2011, 40.0, 8.0)],
                                 "id int, ano int, tdi_em double, taxa_x double")
    yearly = spark.createDataFrame([(2010, 20.0, 1.0)], "ano int, taxa_evasao_em double, taxa_x double")
    out = integrate.integrate_fact(
        fact, yearly, {"taxa_evasao_em": 0.4, "tdi_em": 0.3, "absent": 0.3}, index="i")
    assert rows_of(out, "id", "taxa_x", "i") == [(1, 9.0, 24.29)]


def test_first_per_year_skips_null(spark):
    df = spark.createDataFrame([(1, 2010, None), (2, 2010, "b"), (3, 2010, "c")],
                               "k int, ano int, v string")
    assert rows_of(integrate.first_per_year(df, "v", ["k"]), "ano", "v") == [(2010, "b")]


def test_missing_report(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1.0)], "a int, b double, c double")
    out = quality.missing_by_column({"t": df})
    assert rows_of(out, "coluna", "valores_ausentes", "pct_ausentes", "rank_na_tabela") == [
        ("a", 0, 0.0, 3), ("b", 2, 100.0, 1), ("c", 1, 50.0, 2)]
    assert tuple(quality.missing_global(out).first()) == ("t", 6, 3, 50.0)
    empty = quality.missing_by_column({"t": df.where("false")})
    assert tuple(quality.missing_global(empty).first()) == ("t", 0, 0, 0.0)
    assert tuple(quality.report({"t": df}, {})["formas"].first()) == ("t", "bruta", 2, 3)


def test_min_rank_ties(spark):
    df = spark.createDataFrame([(None, None, 1)], "a int, b int, c int")
    out = quality.missing_by_column({"t": df})
    assert rows_of(out, "coluna", "rank_na_tabela") == [("a", 1), ("b", 1), ("c", 3)]


def test_percent_change(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, 5.0)], "ano int, v double")
    assert rows_of(series.yoy_change(df, ["v"]), "ano", "var_v") == [
        (1, None), (2, None), (3, None), (4, None)]
    gap = spark.createDataFrame([(2010, 4.0), (2012, 5.0)], "ano int, v double")
    assert rows_of(series.yoy_change(gap, ["v"]), "var_v") == [(25.0,), (None,)]


def test_first_year_wins_ties(spark):
    df = spark.createDataFrame([(2010, 5.0), (2009, 5.0), (2011, None)], "ano int, v double")
    row = series.extreme_years(df, ["v"]).first()
    assert (row["ano_max"], row["ano_min"]) == (2009, 2009)


def test_improvements(spark):
    df = spark.createDataFrame([(2010, 9.0, 1.0, None), (2015, 5.0, 1.0, 3.0)],
                               "ano int, a double, b double, c double")
    row = series.improvement_count(df, {"a": True, "b": True, "c": True}).first()
    assert (row["total"], row["melhorias"], row["veredito"]) == (2, 1, "maioria")


def test_kpi_zero_stays_zero(spark):
    df = spark.createDataFrame([(2010, 5.0), (2011, 0.0)], "ano int, v double")
    row = series.kpi_cards(df, ["v"]).first()
    assert (row["valor"], row["delta_pp"], row["situacao"]) == (0.0, -5.0, "positivo")


def test_projection_needs_four_years_and_has_a_floor(spark):
    rows = [(2000 + i, 30.0 - 10 * i) for i in range(4)]
    df = spark.createDataFrame(rows, "ano int, s double")
    out = series.project_trend(df, "s", (20.0, 35.0, 50.0), ("a", "b", "c", "d"))
    assert rows_of(out, "ano", "score_estimado") == [(2004, 0.0), (2005, 0.0)]
    assert series.project_trend(df.limit(3), "s", (1.0,), ("a", "b")).count() == 0


def test_correlation_paths_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 6)) * [1, 10, 1000, 1, 1, 1] + [0, 5, 1e6, 3, 0, 0]
    x[:, 3] = 3.25  # constant
    x[:, 4] = x[:, 0] * 2 + x[:, 4] * 0.1
    data = [tuple(None if rng.random() < 0.2 else float(v) for v in r) for r in x]
    cols = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols))
    pairs = [(a, b) for a in cols for b in cols if a < b]
    many = {(r["a"], r["b"]): (r["r"], r["n"]) for r in stats.corr_pairs(df, pairs, 9).collect()}
    few = {}
    for i in range(0, len(pairs), 5):
        few |= {(r["a"], r["b"]): (r["r"], r["n"])
                for r in stats.corr_pairs(df, pairs[i:i + 5], 9).collect()}
    assert len(many) == 15 and many.keys() == few.keys()
    for k in many:
        assert many[k][1] == few[k][1]
        if "c3" in k:
            assert many[k][0] is None and few[k][0] is None
        else:
            assert many[k][0] == pytest.approx(few[k][0], abs=1e-8)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v), 4.0) for v in range(26)], "v double, k double")
    out = stats.histogram(df, ["v", "k"])
    got = {r["bin"]: r["n"] for r in out.where("indicator = 'v'").collect()}
    assert got == {b: (2 if b == 25 else 1) for b in range(1, 26)}
    assert [r["bin"] for r in out.where("indicator = 'k'").collect()] == [1]


def test_box_numbers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    row = stats.box_numbers(df, "g", "v").first()
    assert (row["q1"], row["q2"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 4.0, 1)
    assert rows_of(stats.box_outliers(df, "g", "v"), "g", "v") == [("g", 100.0)]


def test_line_needs_three_points(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    assert stats.line_fit(df, "x", "y").first()["slope"] is None


def test_metrics_constant_target(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    row = stats.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"]) == (1.0, 1.0, None)


def test_row_extremes_skip_null(spark):
    df = spark.createDataFrame([(1, 5.0, None, 7.0, 5.0)],
                               "id int, a double, b double, c double, d double")
    row = ranking.row_top_indicators(df, ["id"], ["a", "b", "c", "d"]).first()
    assert (row["maiores"], row["menores"]) == ("c,a,d", "a,d")


def test_best_per_group(spark):
    df = spark.createDataFrame([("x", 2.0, "b"), ("x", 2.0, "a"), ("y", 1.0, "c"), ("z", None, "d")],
                               "g string, e double, n string")
    out = ranking.best_per_group(df, "g", "e", ["n"])
    assert rows_of(out, "g", "n", "melhor_geral") == [("x", "a", False), ("y", "c", True)]


def test_cards_show_zero_for_missing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    out = ranking.action_cards(df, (("U", "T", "Valor: %s%%", "a", 1), ("V", "W", "100%", None, 0)))
    assert rows_of(out, "ordem", "indicador") == [(1, "Valor: 0.0%"), (2, "100%")]


def test_union_of_unequal_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "t")], "x int, y string")
    out = integrate.union_splits({"treino": a, "teste": b})
    assert rows_of(out, "x", "split", "y") == [(1, "treino", None), (2, "teste", "t")]


def test_identity_check(spark):
    df = spark.createDataFrame([(2010, 90.0, 10.0), (2010, 50.0, 10.0), (2010, None, 1.0)],
                               "ano int, a double, b double")
    row = cleaning.identity_check(df, ["a", "b"]).first()
    assert (row["n_complete"], row["n_broken"], row["max_gap"]) == (2, 1, 40.0)


def test_shuffle_free_lookup_plan(spark):
    left = spark.range(100).withColumn("ano", F.col("id") % 5)
    right = spark.createDataFrame([(i, i * 1.0) for i in range(5)], "ano long, v double")
    plan = lookup_join(left, right, ["ano"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
