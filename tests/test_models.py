import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelrisk.ml import models, runs, split, store, tune
from panelrisk.ml.prep import feature_array, fit_preparation, medians, modes, scales, split_columns
from panelrisk.operators.stats import regression_metrics
from panelrisk.storage import new_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(300):
        a, b = float(rng.normal()), float(rng.normal() * 3 + 10)
        kind = "xyz"[i % 3]
        y = 2 * a - 0.5 * b + {"x": 0.0, "y": 1.0, "z": 3.0}[kind] + float(rng.normal() * 0.1)
        data.append((i, 2000 + i % 7, None if i % 10 == 0 else a, b, kind, y))
    return spark.createDataFrame(data, "id int, ano int, a double, b double, kind string, y double")


def test_learnt_values(spark):
    df = spark.createDataFrame([(1.0, "u", None), (3.0, "v", None), (8.0, None, None)],
                               "a double, k string, e double")
    assert medians(df, ["a", "e"]) == {"a": 3.0, "e": 0.0}
    assert modes(df, ["k"]) == {"k": "u"}
    assert scales(df, ["a"])["a"] == pytest.approx((4.0, np.std([1, 3, 8])))
    assert split_columns(df, ["e"]) == (["a"], ["k"])


def test_ridge_equals_closed_form(rows):
    train = rows.where(F.col("a").isNotNull())
    preparation = fit_preparation(train, ["a", "b"], [])
    model = models.fit(train, "y", preparation, models.ridge(1.0))
    got = {r["termo"]: r["valor"] for r in models.coefficients(model, train).collect()}
    pdf = train.toPandas()
    x = (pdf[["a", "b"]] - pdf[["a", "b"]].mean()) / pdf[["a", "b"]].std(ddof=0)
    y = pdf["y"] - pdf["y"].mean()
    want = np.linalg.solve(x.T @ x + np.eye(2), x.T @ y)
    assert [got["z_a"], got["z_b"]] == pytest.approx(list(want), abs=1e-6)
    assert got["intercept"] == pytest.approx(pdf["y"].mean(), abs=1e-6)


def test_models_beat_the_mean_and_unseen_values_pass(rows):
    train, test = split.supervised_split(rows, "y", 2004)
    test = test.withColumn("kind", F.when(F.col("id") % 2 == 0, F.col("kind")).otherwise("new"))
    preparation = fit_preparation(train, ["a", "b"], ["kind"])
    for build in (models.ridge(), models.tree(), models.boosting(3, 5, 0.3, 2)):
        model = models.fit(train, "y", preparation, build)
        scored = models.score(model, test, preparation.input_columns())
        assert scored.where(F.col("pred").isNull()).count() == 0
        seen = scored.where("kind <> 'new'")
        assert regression_metrics(seen, "y", "pred").first()["r2"] > 0.3
    with pytest.raises(ValueError, match="kind"):
        models.score(model, test.drop("kind"), preparation.input_columns())


def test_tree_rules_applied_by_sql_give_the_leaf_and_prediction(spark, rows):
    preparation = fit_preparation(rows, ["a", "b"], ["kind"])
    model = models.fit(rows, "y", preparation, models.tree(leaf_col="leaf"))
    names = models.feature_names(model, rows)
    paths = models.tree_paths(models.tree_nodes(spark, model, names))
    tree = model.stages[-1]
    shape = models.tree_shape(paths).first()
    assert (shape["profundidade"], shape["folhas"], shape["n"]) == (tree.depth, (tree.numNodes + 1) // 2, 300)
    told = models.apply_paths(paths, model.transform(rows).select("id", "a", "b", "kind", "leaf", "pred"), model, names).toPandas()
    assert (told["folha_regra"] == told["leaf"]).all() and (told["pred_regra"] == told["pred"]).all()
    vectors = feature_array(rows, PipelineModel(model.stages[:-1])).select("id", "vec").toPandas()
    long = pd.DataFrame([(i, n, v) for i, vec in zip(vectors["id"], vectors["vec"]) for n, v in zip(names, vec)],  # noqa: F841
                        columns=["id", "coluna", "v"])
    steps = paths.toPandas()  # noqa: F841
    by_sql = duckdb.sql("""
        select id, folha, any_value(previsao) as previsao from long join steps using (coluna)
        group by id, folha having bool_and(case when lado = '<=' then v <= corte else v > corte end)""").df().set_index("id")
    assert len(by_sql) == 300
    for r in told.itertuples():
        assert by_sql.loc[r.id, "folha"] == r.leaf and by_sql.loc[r.id, "previsao"] == r.pred
    rules = {r["folha"]: r["regra"] for r in models.tree_rules(paths).collect()}
    assert len(rules) == shape["folhas"] and all(" e " in t or "<=" in t or ">" in t for t in rules.values())


def test_tree_of_one_leaf(spark, rows):
    flat = rows.withColumn("y", F.lit(4.0))
    preparation = fit_preparation(flat, ["a"], [])
    model = models.fit(flat, "y", preparation, models.tree())
    paths = models.tree_paths(models.tree_nodes(spark, model, models.feature_names(model, flat)))
    assert [(r["folha"], r["passo"], r["coluna"], r["previsao"]) for r in paths.collect()] == [(0, 0, None, 4.0)]
    assert models.tree_rules(paths).first()["regra"] == "sempre"
    assert models.tree_shape(paths).first()["profundidade"] == 0


def test_empty_split_is_an_error(rows):
    with pytest.raises(ValueError, match="empty"):
        split.supervised_split(rows, "y", 1990)


def test_model_roundtrip(spark, rows):
    preparation = fit_preparation(rows, ["a", "b"], ["kind"])
    model = models.fit(rows, "y", preparation, models.tree())
    path = new_path(spark, "model")
    store.save_model(spark, model, path, "y", preparation.input_columns(), {"maxDepth": 4},
                     [2001, 2002], 2004)
    stored = store.load_model(spark, path)
    assert stored.inputs == ["a", "b", "kind"] and stored.params == {"maxDepth": "4"}
    direct = models.score(model, rows, stored.inputs).select("id", "pred").collect()
    again = stored.predict(rows).select("id", "pred").collect()
    assert sorted(direct) == sorted(again)


def folds_of(spark, years, n):
    df = spark.createDataFrame([(y,) for y in years], "ano int")
    return split.fold_years(split.year_folds(df, n))


def test_year_folds(spark):
    years = list(range(2008, 2018))
    got = folds_of(spark, years * 2, 4)
    assert [v for _, _, v in got] == [[2010, 2011], [2012, 2013], [2014, 2015], [2016, 2017]]
    assert all(max(t) < min(v) for _, t, v in got)
    assert len(folds_of(spark, [2001, 2002, 2003], 9)) == 2
    with pytest.raises(Exception, match="3 years"):
        folds_of(spark, [2001, 2002], 4)


def test_draws_are_distinct_points_of_the_space():
    space = {"a": (1, 2, 3), "b": ("x", "y")}
    got = tune.draw_settings(space, 4)
    assert len({tuple(p.items()) for p in got}) == 4
    assert len(tune.draw_settings(space, 99)) == 6
    assert got == tune.draw_settings(space, 4)


def test_flatten():
    assert runs.flatten({"a": {"b": 1, "c": {"d": 2}}, "e": None}) == {
        "a.b": "1", "a.c.d": "2", "e": "None"}


def test_fold_errors_from_yearly_sums(spark, rows):
    scored = rows.withColumn("pred", F.lit(0.0) + F.col("b") * -0.4)
    folds = split.year_folds(scored, 3)
    fast = {(r["fold"], r["role"]): r for r in tune.cv_errors(scored, "y", "pred", folds).collect()}
    slow = regression_metrics(scored.join(folds, "ano"), "y", "pred", ["fold", "role"]).collect()
    assert len(slow) == len(fast)
    for r in slow:
        f = fast[(r["fold"], r["role"])]
        assert f["n"] == r["n"]
        for m in ("mae", "rmse", "r2"):
            assert f[m] == pytest.approx(r[m], abs=1e-9)


@pytest.mark.parametrize("gap,sd,r2,word", [
    (1.6, 0.1, 0.9, "instabilidade"), (0.1, 1.6, 0.9, "instabilidade"),
    (0.7, 0.1, 0.9, "overfitting"), (0.1, 0.1, 0.1, "underfitting"), (0.1, 0.1, 0.9, "estável")])
def test_diagnosis(spark, gap, sd, r2, word):
    row = spark.createDataFrame(
        [(1.0 + gap, 1.0, sd, r2)],
        "mae_validacao_media double, mae_treino_media double, mae_validacao_dp double,"
        " r2_validacao_media double")
    assert word in tune.cv_diagnosis(row).first()["diagnostico"]


def test_importance_finds_the_used_column(rows):
    data = rows.withColumn("noise", F.rand(3)).where(F.col("a").isNotNull())
    preparation = fit_preparation(data, ["a", "b", "noise"], [])
    model = models.fit(data, "y", preparation, models.tree())
    out = tune.permutation_importance(model, data, "y", ["a", "b", "noise"], ["id"], 3).collect()
    assert out[-1]["coluna"] == "noise" and out[0]["importancia"] > 0.3
    assert all(r["repeticoes"] == 3 for r in out)


def test_groups_are_fitted_on_rows_that_are_not_cached(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler

    from panelrisk.ml import cluster

    seen, fits = [], cluster._fits
    monkeypatch.setattr(cluster, "_fits", lambda rows, points: seen.append(rows) or fits(rows, points))
    data = spark.range(60).selectExpr("cast(id % 3 * 100 + id / 60 as double) as x", "cast(id % 3 as double) as y")
    model, curve = cluster.choose_k(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(data), (2, 3, 4), (1, 2))
    assert model.summary.k == 3 and [k for k, _, _ in curve] == [2, 3, 4]
    level = seen[0].storageLevel
    assert not level.useMemory and not level.useDisk and seen[0].columns == ["features"]


def test_search_on_stored_features_gives_the_errors_of_whole_pipelines(rows):
    space = {"stepSize": (0.1, 0.3), "maxDepth": (2, 3), "maxIter": (2, 4), "minInstancesPerNode": (2,)}
    ranked = tune.tune(rows, "y", ["a", "b"], ["kind"], space, 4, 2)
    points = tune.draw_settings(space, 4)
    want = {i: [] for i in range(4)}
    for _, early, late in split.fold_years(split.year_folds(rows, 2)):
        inner, outer = split.rows_of(rows, early), split.rows_of(rows, late)
        preparation = fit_preparation(inner, ["a", "b"], ["kind"])
        for i, point in enumerate(points):
            model = models.fit(inner, "y", preparation, tune.boosting_from(point))
            want[i].append([tune._errors(model, r, preparation.input_columns(), "y")["mae"] for r in (inner, outer)])
    for r in ranked.collect():
        assert r["parametros"] == runs.flatten(points[r["tentativa"]])
        mean = np.mean(want[r["tentativa"]], axis=0)
        assert (r["mae_treino_media"], r["mae_validacao_media"]) == pytest.approx(tuple(mean), abs=1e-9)


def test_campaign_runs_every_named_setting():
    plan = tune.campaign_plan()
    assert len({name for name, _, _ in plan}) == len(plan) == 30
    by = {a: [p for _, algorithm, p in plan if algorithm == a] for a in ("boosting", "tree", "knn")}
    assert all(len({tuple(p.items()) for p in listed}) == 10 for listed in by.values())
    assert {p["maxIter"] for p in by["boosting"]} == {60, 80, 150, 180, 200, 220, 250, 280, 300}
    assert {p["maxDepth"] for p in by["tree"]} == set(range(2, 9))
    assert {p["k"] for p in by["knn"]} == {3, 4, 5, 6, 7, 9, 11, 13, 15}


def test_campaign_errors_are_those_of_single_fits(rows):
    train, test = split.supervised_split(rows, "y", 2004)
    twice = train.unionByName(train.withColumn("id", F.col("id") + 1000))  # equal points, ties
    plan = [("b", "boosting", {"stepSize": 0.3, "maxDepth": 2, "maxIter": 3, "minInstancesPerNode": 2}),
            ("t", "tree", {"maxDepth": 3, "minInstancesPerNode": 4}),
            *[(f"k{k}{w}", "knn", {"k": k, "weights": w}) for k in (3, 7) for w in ("uniform", "distance")]]
    table = tune.run_campaign(twice, test, "y", ["id"], ["a", "b"], ["kind"], plan)
    got = {r["nome"]: r for r in table.where("parent_id is not null").collect()}
    preparation = fit_preparation(twice, ["a", "b"], ["kind"])
    for name, algorithm, params in plan:
        if algorithm == "knn":
            near = models.knn_predict(twice, test, "y", preparation, ["id"], params["k"], params["weights"])
            want = regression_metrics(test.select("id", "y").join(near, ["id"]), "y", "pred").first()
        else:
            build = tune.boosting_from(params) if algorithm == "boosting" else models.tree(3, 4)
            want = tune._errors(models.fit(twice, "y", preparation, build), test, preparation.input_columns(), "y")
        assert got[name]["parametros"] == runs.flatten(params) and got[name]["algoritmo"] == algorithm
        for m in ("mae", "rmse", "r2"):
            assert got[name]["metricas"][f"test_{m}"] == pytest.approx(want[m], abs=1e-9)
