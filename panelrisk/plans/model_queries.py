"""Registered modelling queries.

Expensive fits are made once per session and folder and shared by the queries
that need them. ``tune_boosting`` draws fewer settings than its operator's
defaults (see the README).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk import settings
from panelrisk.functions.columns import half_even, level_of
from panelrisk.ml import cluster, models, neighbors, scenario, split, store, tune
from panelrisk.ml.prep import (
    feature_array, fill, fit_features, fit_preparation, medians, modes, scales, standardize,
)
from panelrisk.operators import stats
from panelrisk.plans import suite
from panelrisk.plans.inputs import UNIT_KEYS, formula_scored, joined_rows
from panelrisk.sources import panel as recipe
from panelrisk.sources.panel import INDICATORS, TARGET, panel
from panelrisk.sources.tables import append_rows, parquet_table, read_or_none
from panelrisk.storage import materialize, new_path

# Without the target, what is binned from it and its complement to 100.
NUMERIC = ["ano", "aband_ef", "reprov_em", "tdi_em", "atu_em", "had_em",
           "evasao_em", "evasao_ef", "repet_em", "promo_em"]
CATEGORICAL = ["periodo", "risco_ef"]
PROFILE = ["tdi_em", "reprov_em", "aband_ef", "atu_em", "had_em"]
NEAR_PROFILE = ["tdi_em", "reprov_em", TARGET, "atu_em"]
SMALL_SPACE = {"stepSize": (0.1, 0.3), "maxDepth": (2, 3), "maxIter": (3, 6),
               "minInstancesPerNode": (2, 5)}

# panel column -> column whose label, range and default it takes
SCENARIO_NAMES = {"tdi_em": "tdi_em", "reprov_em": "taxa_reprovacao_em",
                  "aprov_em": "taxa_aprovacao_em", "aband_ef": "taxa_abandono_ef",
                  "atu_em": "atu_em", "had_em": "had_em"}
SCENARIO_INPUTS = {c: settings.SCENARIO_INPUTS[n] for c, n in SCENARIO_NAMES.items()}
SCENARIOS = {
    "tdi_menor": {"tdi_em": -5.0},
    "turma_menor": {"atu_em": -3.0, "had_em": 0.5},
    "apoio_amplo": {"tdi_em": -10.0, "reprov_em": -5.0, "aband_ef": -2.0},
    "piora": {"tdi_em": 15.0, "aband_ef": 3.0},
    "sem_mudanca": {},
}


_made: dict[tuple, object] = {}


def once(spark, folder, name: str, make):
    """What ``make`` gives, kept for this session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the fact, each written once because fits read them often."""
    rows = materialize(joined_rows(spark, folder).where(F.col(TARGET).isNotNull()), "fact")
    return split.supervised_split(rows, TARGET, recipe.SPLIT_YEAR)


def panel_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = materialize(panel(spark, folder), "panel")
    return split.supervised_split(rows, TARGET, recipe.SPLIT_YEAR)


# -- preparation and split

def impute_median(spark, folder):
    rows, train = panel(spark, folder), panel(spark, folder, last=recipe.SPLIT_YEAR)
    found = medians(train, INDICATORS)
    return fill(rows, found).select(*UNIT_KEYS, *[half_even(c, 6).alias(c) for c in INDICATORS])


def impute_mode(spark, folder):
    level = level_of(TARGET, settings.RATE_CUTS, settings.RATE_LABELS, missing=None)
    rows = panel(spark, folder).select(*UNIT_KEYS, level.alias("nivel"))
    train, _ = split.temporal_split(rows, recipe.SPLIT_YEAR)
    return fill(rows, modes(train, ["nivel"]))


def standardize_rows(spark, folder):
    rows, train = panel(spark, folder), panel(spark, folder, last=recipe.SPLIT_YEAR)
    scaled = standardize(rows, scales(train, INDICATORS))
    return scaled.select(*UNIT_KEYS, *[half_even(c, 6).alias(c) for c in INDICATORS])


def temporal_split(spark, folder):
    train = panel(spark, folder, last=recipe.SPLIT_YEAR)
    test = panel(spark, folder, first=recipe.SPLIT_YEAR + 1)
    return train.withColumn("split", F.lit("treino")).unionByName(
        test.withColumn("split", F.lit("teste"))
    )


def split_summary(spark, folder):
    return split.split_summary(panel(spark, folder), TARGET, recipe.SPLIT_YEAR)


def _train_years(spark, folder):
    return formula_scored(spark, folder, last=recipe.SPLIT_YEAR)


def year_folds(spark, folder):
    return split.year_folds(_train_years(spark, folder), 4)


def _fold_errors(spark, folder):
    rows = _train_years(spark, folder)
    return tune.cv_errors(rows, TARGET, "pred", split.year_folds(rows, 4))


def cv_errors(spark, folder):
    return stats.round_columns(_fold_errors(spark, folder), {"mae": 6, "rmse": 6, "r2": 6})


def cv_summary(spark, folder):
    table = tune.cv_summary(_fold_errors(spark, folder))
    return stats.round_columns(table, {c: 6 for c in table.columns if c != "n_folds"})


def cv_diagnosis(spark, folder):
    return tune.cv_diagnosis(tune.cv_summary(_fold_errors(spark, folder)))


# -- neighbours

def _vectors(spark, folder):
    train, test = panel_sides(spark, folder)
    model = fit_features(train, fit_preparation(train, PROFILE, []))
    return feature_array(test, model), feature_array(train, model)


def knn_neighbors(spark, folder):
    query, train = _vectors(spark, folder)
    near = neighbors.nearest(query, train, "vec", UNIT_KEYS, UNIT_KEYS, 5)
    return near.withColumn("distancia", half_even("distancia", 6))


def knn_embeddings(spark, folder):
    rows = parquet_table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec")
    )
    near = neighbors.nearest(rows, rows, "vec", ["vec_id"], ["vec_id"], 6)
    return neighbors.without_self(near, ["vec_id"], 5).withColumn(
        "distancia", half_even("distancia", 6)
    )


def knn_regress(spark, folder):
    query, train = _vectors(spark, folder)
    found = neighbors.knn_regress(query, train, "vec", UNIT_KEYS, UNIT_KEYS, TARGET, 5)
    return found.withColumn("pred", half_even("pred", 6))


def knn_profile(spark, folder):
    query, train = _vectors(spark, folder)
    near = neighbors.nearest(query, train, "vec", UNIT_KEYS, UNIT_KEYS, 5, NEAR_PROFILE)
    table = neighbors.knn_profile(near, query, UNIT_KEYS, NEAR_PROFILE)
    return stats.round_columns(table, {f"media_{c}": 6 for c in NEAR_PROFILE})


# -- models

def ridge_fit(spark, folder):
    train, _ = sides(spark, folder)
    preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
    return models.coefficients(models.fit(train, TARGET, preparation, models.ridge(1.0)), train)


def _test_scores(spark, folder, build):
    train, test = sides(spark, folder)
    preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
    model = models.fit(train, TARGET, preparation, build)
    return models.score(model, test, preparation.input_columns()).select(*UNIT_KEYS, TARGET, "pred")


def _boosted(spark, folder):
    """(train, test, preparation, model): the boosting with its full number of trees."""
    def make():
        train, test = sides(spark, folder)
        preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
        return train, test, preparation, models.fit(train, TARGET, preparation, models.boosting())
    return once(spark, folder, "boosting", make)


def boosting_fit(spark, folder):
    _, test, preparation, model = _boosted(spark, folder)
    return models.score(model, test, preparation.input_columns()).select(*UNIT_KEYS, TARGET, "pred")


def tree_fit(spark, folder):
    return _test_scores(spark, folder, models.tree())


def _compared(spark, folder):
    def make():
        train, test, _, _ = _boosted(spark, folder)
        builders = {"tree": models.tree(), "ridge": models.ridge()}
        rest = models.compare(train, test, TARGET, UNIT_KEYS, NUMERIC, CATEGORICAL, builders, {"knn": 5})
        own = boosting_fit(spark, folder).select(F.lit("boosting").alias("modelo"), *UNIT_KEYS, TARGET, "pred")
        return materialize(rest.unionByName(own), "compared")
    return once(spark, folder, "compared", make)


def compare_models(spark, folder):
    return models.metrics_table(_compared(spark, folder), TARGET)


def compare_text(spark, folder):
    return models.compare_text(models.metrics_table(_compared(spark, folder), TARGET))


def residual_box(spark, folder):
    return stats.residual_box(_compared(spark, folder), TARGET, "pred", "modelo")


def _formula_rows(spark, folder):
    return formula_scored(spark, folder).withColumn("modelo", F.when(F.col("ent") % 2 == 0, "par").otherwise("impar"))


def residual_box_formula(spark, folder):
    """Residual numbers of the formula prediction, for two groups of units."""
    table = stats.residual_box(_formula_rows(spark, folder), TARGET, "pred", "modelo")
    return stats.round_columns(table, {c: 6 for c in ("q1", "q2", "q3", "whisker_low", "whisker_high")})


def compare_text_formula(spark, folder):
    return models.compare_text(models.metrics_table(_formula_rows(spark, folder), TARGET))


def cluster_profiles_given(spark, folder):
    """Profiles of groups that a column already holds."""
    rows = panel(spark, folder).withColumn("cluster", (F.col("ent") % 3).cast("int"))
    return cluster.cluster_profiles(rows, [TARGET, "tdi_em", "atu_em"], TARGET)


def missing_impact(spark, folder):
    train, test = sides(spark, folder)
    return models.missing_impact(train, test, TARGET, NUMERIC, CATEGORICAL, 0.3)


def tune_boosting(spark, folder):
    train, _ = sides(spark, folder)
    return tune.tune(train, TARGET, NUMERIC, CATEGORICAL, SMALL_SPACE, 3, 2)


def learning_curve(spark, folder):
    train, _ = sides(spark, folder)
    return tune.learning_curve(
        train, TARGET, NUMERIC, CATEGORICAL, models.tree(), UNIT_KEYS, n_splits=4
    )


def perm_importance(spark, folder):
    _, test, preparation, model = _boosted(spark, folder)
    # a row is told by ent alone within a shuffle: the year is an input too
    rows = test.withColumn("_id", F.concat_ws("-", *UNIT_KEYS))
    return tune.permutation_importance(model, rows, TARGET, preparation.input_columns(), ["_id"], 8)


def _stored_model(spark, folder):
    train, test = sides(spark, folder)
    preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
    model = models.fit(train, TARGET, preparation, models.tree())
    path = new_path(spark, "model")
    store.save_model(spark, model, path, TARGET, preparation.input_columns(), {"maxDepth": 4},
                     range(1996, recipe.SPLIT_YEAR + 1), recipe.SPLIT_YEAR)
    return model, preparation, test, path


def model_roundtrip(spark, folder):
    model, preparation, test, path = _stored_model(spark, folder)
    direct = models.score(model, test, preparation.input_columns(), "pred_direto")
    return store.load_model(spark, path).predict(direct, "pred_lido").select(
        *UNIT_KEYS, (F.col("pred_direto") == F.col("pred_lido")).alias("igual"),
    )


def score_batch(spark, folder):
    _, _, _, path = _stored_model(spark, folder)
    found = store.load_model(spark, path).predict(joined_rows(spark, folder))
    level = level_of("pred", settings.PREDICTION_CUTS, settings.PREDICTION_LABELS, "left")
    return found.select(*UNIT_KEYS, TARGET, "pred", level.alias("faixa"))


def tree_leaf_table(spark, folder):
    train, _ = sides(spark, folder)
    preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
    model = models.fit(train, TARGET, preparation, models.tree(leaf_col="folha_"))
    return models.tree_leaf_table(model, train, TARGET, PROFILE, "folha_")


def _tree_rules(spark, folder):
    """(paths, train and test rows, model, feature names) of the fitted tree."""
    def make():
        train, test = sides(spark, folder)
        preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
        model = models.fit(train, TARGET, preparation, models.tree(leaf_col="folha_"))
        names = models.feature_names(model, train)
        paths = materialize(models.tree_paths(models.tree_nodes(spark, model, names)), "paths")
        return paths, train.unionByName(test), model, names
    return once(spark, folder, "rules", make)


def tree_paths(spark, folder):
    return _tree_rules(spark, folder)[0]


def tree_rules(spark, folder):
    return models.tree_rules(_tree_rules(spark, folder)[0])


def tree_shape(spark, folder):
    return models.tree_shape(_tree_rules(spark, folder)[0])


def tree_paths_hold(spark, folder):
    """Whether the rules give every row the leaf and the prediction of the model."""
    paths, rows, model, names = _tree_rules(spark, folder)
    placed = model.transform(rows).select(*rows.columns, F.col("folha_").cast("int").alias("folha_"), "pred")
    told = models.apply_paths(paths, placed, model, names)
    return told.select(
        *UNIT_KEYS, F.col("folha_regra").eqNullSafe(F.col("folha_")).alias("mesma_folha"),
        F.col("pred_regra").eqNullSafe(F.col("pred")).alias("mesma_previsao"))


def risk_ranking(spark, folder):
    options = suite.SuiteOptions(TARGET, UNIT_KEYS, NUMERIC, CATEGORICAL, recipe.SPLIT_YEAR)
    return suite.scored_table(joined_rows(spark, folder), options)[0]


def run_campaign(spark, folder):
    train, test = sides(spark, folder)
    plan = tune.campaign_plan()
    path = new_path(spark, "runs")
    done = tune.run_campaign(train, test, TARGET, UNIT_KEYS, NUMERIC, CATEGORICAL, plan)
    append_rows(done, path)
    return tune.campaign_summary(read_or_none(spark, path))


# -- groups

def _grouped(spark, folder):
    """Groups for the best k of 2 to 8, each from ten starts."""
    def make():
        train, test = sides(spark, folder)
        features = fit_features(train, fit_preparation(train, NUMERIC, CATEGORICAL))
        prepared = materialize(features.transform(train), "prepared")
        model, curve = cluster.choose_k(prepared, tuple(range(2, 9)), tuple(range(42, 52)))
        return train, train.unionByName(test), features, model, curve
    return once(spark, folder, "groups", make)


def kmeans_select(spark, folder):
    train, _, _, model, curve = _grouped(spark, folder)
    return cluster.curve_table(train, curve, model.summary.k)


def kmeans_assign(spark, folder):
    _, both, features, model, _ = _grouped(spark, folder)
    return cluster.assign(model, features, both).select(*UNIT_KEYS, "cluster")


def _profiles(spark, folder):
    _, both, features, model, _ = _grouped(spark, folder)
    cols = [TARGET, "tdi_em", "reprov_em", "repet_em", "atu_em"]
    return cluster.cluster_profiles(cluster.assign(model, features, both), cols, TARGET), cols


def cluster_profiles(spark, folder):
    return _profiles(spark, folder)[0]


def cluster_text(spark, folder):
    table, cols = _profiles(spark, folder)
    return cluster.cluster_text(materialize(table, "profiles"), cols)


def pca_2d(spark, folder):
    train, test = sides(spark, folder)
    features = fit_features(train, fit_preparation(train, NUMERIC, CATEGORICAL))
    both = features.transform(train.unionByName(test))
    return cluster.pca_2d(both, both, UNIT_KEYS)


# -- what-if

def _grid(spark, folder):
    return scenario.scenario_grid(
        panel(spark, folder), UNIT_KEYS, SCENARIO_INPUTS, SCENARIOS, ("aprov_em", "reprov_em", TARGET)
    )


def _formula(prefix: str) -> Column:
    return (
        F.lit(1.0) + F.lit(0.25) * F.col(f"{prefix}tdi_em")
        + F.lit(0.5) * F.col(f"{prefix}aband_ef") + F.lit(0.05) * F.col(f"{prefix}atu_em")
    )


def scenario_grid(spark, folder):
    return _grid(spark, folder)


def scenario_delta(spark, folder):
    scored = scenario.scenario_delta(_grid(spark, folder), _formula)
    return scored.select(
        *UNIT_KEYS, "cenario", *[half_even(c, 6).alias(c)
                                 for c in ("pred_original", "pred_simulada", "diferenca")], "efeito"
    )


def scenario_text(spark, folder):
    scored = scenario.scenario_delta(_grid(spark, folder), _formula)
    return scenario.scenario_text(scored, UNIT_KEYS, SCENARIO_INPUTS)


def scenario_changes(spark, folder):
    return scenario.scenario_changes(_grid(spark, folder), UNIT_KEYS, SCENARIO_INPUTS)


def scenario_model(spark, folder):
    """What-if with a fitted model: the same rows scored before and after."""
    train, _ = sides(spark, folder)
    preparation = fit_preparation(train, NUMERIC, CATEGORICAL)
    model = models.fit(train, TARGET, preparation, models.tree())
    inputs = preparation.input_columns()
    fixed = [c for c in inputs if c not in SCENARIO_INPUTS]
    rows = joined_rows(spark, folder).select("ent", *inputs, "aprov_em")
    grid = scenario.scenario_grid(rows, ["ent", *fixed], SCENARIO_INPUTS, SCENARIOS)
    return scenario.score_grid(grid, model, inputs, SCENARIO_INPUTS).select(
        *UNIT_KEYS, "cenario", "pred_original", "pred_simulada", "diferenca", "efeito"
    )


QUERIES = {
    f.__name__: f for f in (
        impute_median, impute_mode, temporal_split, split_summary, year_folds, cv_errors,
        cv_summary, cv_diagnosis, knn_neighbors, knn_embeddings, knn_regress, knn_profile,
        scenario_grid, scenario_delta, scenario_text, scenario_changes, scenario_model, ridge_fit,
        boosting_fit, tree_fit, compare_models, compare_text, residual_box, missing_impact,
        tune_boosting, learning_curve, perm_importance, model_roundtrip, score_batch,
        tree_leaf_table, tree_paths, tree_rules, tree_shape, tree_paths_hold, residual_box_formula, compare_text_formula, cluster_profiles_given,
        kmeans_select, kmeans_assign, cluster_profiles, cluster_text, pca_2d,
        risk_ranking, run_campaign,
    )
} | {"standardize": standardize_rows}
