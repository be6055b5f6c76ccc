"""The whole modelling run: compare, cluster, tune, score, rank, refit, save."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelrisk import settings
from panelrisk.functions.columns import half_even
from panelrisk.ml import cluster, models, runs, store, tune
from panelrisk.ml.prep import fit_features, fit_preparation
from panelrisk.ml.split import supervised_split
from panelrisk.operators.integrate import union_splits
from panelrisk.operators.ordering import dense_rank_rows
from panelrisk.sources.tables import read_or_none, write_tables
from panelrisk.storage import materialize


@dataclass
class SuiteOptions:
    target: str
    ids: Sequence[str]
    numeric: Sequence[str]
    categorical: Sequence[str]
    cutoff: int
    boosting: Mapping = field(default_factory=dict)
    tree: Mapping = field(default_factory=dict)
    neighbours: int = 5
    ks: Sequence[int] = (2, 3, 4, 5, 6, 7, 8)
    starts: Sequence[int] = tuple(range(42, 52))
    space: Mapping = field(default_factory=lambda: settings.SEARCH_SPACE)
    draws: int = 18
    splits: int = 4
    profile: Sequence[str] = ()


def scored_table(rows: DataFrame, options: SuiteOptions) -> tuple[DataFrame, dict]:
    """Train and test rows with every prediction, the group and the risk place.

    Also returns what was fitted on the way.
    """
    o = options
    train, test = supervised_split(rows, o.target, o.cutoff)
    train, test = materialize(train, "train"), materialize(test, "test")
    preparation = fit_preparation(train, o.numeric, o.categorical)
    inputs = preparation.input_columns()
    ranked = tune.tune(train, o.target, o.numeric, o.categorical, o.space, o.draws, o.splits)
    point = tune.best_point(ranked, o.space)
    both = union_splits({"treino": train, "teste": test})
    all_rows = both.drop("split")
    final = tune.boosting_from(point)
    builders = {"pred_boosting": models.boosting(**o.boosting), "pred_tree": models.tree(**o.tree), "pred_final": final}
    fits = [(train, preparation, build) for build in builders.values()]
    fits.append((all_rows, fit_preparation(all_rows, o.numeric, o.categorical), final))
    *made, final_all = tune.in_threads(
        rows.sparkSession, lambda f: models.fit(f[0], o.target, f[1], f[2]), fits, len(fits))
    fitted = dict(zip(builders, made))
    features = fit_features(train, preparation)
    prepared = materialize(features.transform(train), "prepared")
    groups, curve = cluster.choose_k(prepared, o.ks, o.starts)
    out = cluster.assign(groups, features, both)
    for name, model in {**fitted, "pred_final_all": final_all}.items():
        out = models.score(model, out, inputs, name)
    near = models.knn_predict(train, all_rows, o.target, preparation, o.ids, o.neighbours)
    out = out.join(near.withColumnRenamed(models.PREDICTION, "pred_knn"), list(o.ids))
    keep = [*o.ids, o.target, "split", *fitted, "pred_knn", "pred_final_all", cluster.CLUSTER]
    extra = [c for c in o.profile if c not in keep]
    out = materialize(out.select(*keep, *extra), "scored")
    tests = dense_rank_rows(
        out.where(F.col("split") == "teste"), "pred_final", o.ids, "posicao_risco"
    )
    trained = out.where(F.col("split") == "treino").withColumn(
        "posicao_risco", F.lit(None).cast("long")
    )
    parts = {
        "tuning": ranked, "point": point, "curve": curve, "k": groups.summary.k,
        "final_all": final_all, "inputs": inputs, "train": train,
    }
    return materialize(trained.unionByName(tests), "ranked"), parts


def run_suite(rows: DataFrame, options: SuiteOptions, folder: str) -> dict[str, DataFrame]:
    """Full run with its tables written to ``folder`` and the model saved next to them."""
    spark, o = rows.sparkSession, options
    scored, parts = scored_table(rows, o)
    names = ["pred_boosting", "pred_tree", "pred_knn", "pred_final"]
    test = scored.where(F.col("split") == "teste")
    stacked = test.select(*o.ids, o.target, *names).unpivot(
        [*o.ids, o.target], names, "modelo", models.PREDICTION
    )
    metrics = materialize(models.metrics_table(stacked, o.target), "metrics")
    final = tune.boosting_from(parts["point"])
    errors = tune.cross_validate(
        parts["train"], o.target, o.numeric, o.categorical, final, o.splits
    )
    profile = [o.target, *[c for c in o.profile if c in scored.columns and c != o.target]]
    tables = {
        "scored": scored,
        "metrics": metrics,
        "tuning": parts["tuning"],
        "cv_folds": errors,
        "cv_summary": tune.cv_summary(errors),
        "cv_diagnosis": tune.cv_diagnosis(tune.cv_summary(errors)),
        "learning_curve": tune.learning_curve(
            parts["train"], o.target, o.numeric, o.categorical, final, o.ids, o.splits
        ),
        "clusters": cluster.cluster_profiles(scored, profile, o.target),
        "kmeans_curve": cluster.curve_table(scored, parts["curve"], parts["k"]),
    }
    tables["summary"] = metrics.select(
        F.to_json(F.struct("modelo", "n", half_even("mae", 6).alias("mae"),
                           half_even("rmse", 6).alias("rmse"), half_even("r2", 6).alias("r2")))
        .alias("resumo")
    )
    tables["runs"] = _run_log(tables, options, parts)
    write_tables(tables, folder)
    years = [r["ano"] for r in scored.select("ano").distinct().orderBy("ano").collect()]
    store.save_model(spark, parts["final_all"], f"{folder}/final_model", o.target,
                     parts["inputs"], parts["point"], years, o.cutoff)
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in tables}


SUMMARY = "modelo string, n long, mae double, rmse double, r2 double"


def read_summary(spark: SparkSession, folder: str) -> DataFrame | None:
    """The parsed JSON summary of a run, or None where there is none."""
    stored = read_or_none(spark, f"{folder}/summary.parquet")
    if stored is None:
        return None
    return stored.select(F.from_json("resumo", SUMMARY).alias("s")).select("s.*")


def _run_log(tables: Mapping[str, DataFrame], o: SuiteOptions, parts: Mapping) -> DataFrame:
    spark = tables["metrics"].sparkSession
    parent = runs.new_run("suite", None, {"ano_corte": o.cutoff, "k": parts["k"]}, {})
    rows = [parent]
    for r in tables["metrics"].collect():  # one row per model
        numbers = {"test_mae": r["mae"], "test_rmse": r["rmse"], "test_r2": r["r2"]}
        params = {"best": parts["point"]} if r["modelo"] == "pred_final" else {}
        rows.append(runs.new_run(r["modelo"], r["modelo"], params, numbers, {}, parent[0]))
    return runs.runs_table(spark, rows)


