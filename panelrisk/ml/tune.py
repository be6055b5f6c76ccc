"""Model search and validation over year folds."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelrisk import settings
from panelrisk.functions.columns import half_even
from panelrisk.ml import models, runs
from panelrisk.ml.neighbors import nearest, neighbour_mean
from panelrisk.ml.prep import FEATURES, fit_features, fit_preparation
from panelrisk.ml.split import fold_years, rows_of, year_folds
from panelrisk.operators.ordering import number_rows
from panelrisk.operators.stats import regression_metrics
from panelrisk.storage import materialize

WORKERS = 2  # each fit is a distributed job of its own
FITS = 8  # fits of a search at the same time: each is thousands of short jobs with gaps between them


def in_threads(
    spark: SparkSession, task: Callable, items: Sequence, workers: int = WORKERS
) -> list:
    if workers <= 1 or len(items) <= 1:
        return [task(x) for x in items]
    with ThreadPool(workers) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items, 1)


def longest_first(spark: SparkSession, task: Callable, items: Sequence, points: Sequence[Mapping]) -> list:
    """Results in the order of the items; those whose point has the most turns begin first."""
    order = sorted(range(len(items)), key=lambda i: -points[i].get("maxIter", 1))
    found = dict(zip(order, in_threads(spark, task, [items[i] for i in order], FITS)))
    return [found[i] for i in range(len(items))]


def draw_settings(space: Mapping[str, Sequence], draws: int, seed: int = models.SEED) -> list[dict]:
    """Distinct random points of a discrete space; all of them if it is small."""
    sizes = [len(v) for v in space.values()]
    total = reduce(lambda a, b: a * b, sizes, 1)
    picks = random.Random(seed).sample(range(total), min(draws, total))
    out = []
    for p in picks:
        point = {}
        for (name, values), size in zip(space.items(), sizes):
            p, i = divmod(p, size)
            point[name] = values[i]
        out.append(point)
    return out


def boosting_from(point: Mapping) -> models.Builder:
    return models.boosting(
        max_depth=point["maxDepth"], max_iter=point["maxIter"], step=point["stepSize"],
        min_leaf=point["minInstancesPerNode"],
    )


def _errors(model: Model, rows: DataFrame, inputs: Sequence[str], target: str) -> dict:
    scored = models.score(model, rows, inputs)
    row = regression_metrics(scored, target, models.PREDICTION).first()
    return {"mae": row["mae"], "rmse": row["rmse"], "r2": row["r2"]}


def tune(
    train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
    space: Mapping[str, Sequence] = settings.SEARCH_SPACE, draws: int = 18, n_splits: int = 4,
    builder: Callable[[Mapping], models.Builder] = boosting_from, seed: int = models.SEED,
    year: str = "ano",
) -> DataFrame:
    """Random search by mean validation MAE over year folds, ranked.

    The preparation is learnt once per fold, on its training years only, and its
    prepared rows are stored for the fits of the fold.
    """
    spark = train.sparkSession
    points = draw_settings(space, draws, seed)
    folds = fold_years(year_folds(train, n_splits, year), year)

    def prepare(fold: tuple) -> tuple:
        number, early, late = fold
        inner, outer = rows_of(train, early, year), rows_of(train, late, year)
        features = fit_features(inner, fit_preparation(inner, numeric, categorical))
        return (number, *[materialize(features.transform(r).select(target, FEATURES), "fold")
                          for r in (inner, outer)])

    def run(task: tuple) -> tuple:
        (number, inner, outer), i = task
        model = builder(points[i])(inner, target).fit(inner)
        return (i, number, runs.flatten(points[i]), _errors(model, inner, [FEATURES], target)["mae"],
                _errors(model, outer, [FEATURES], target)["mae"])

    tasks = [(fold, i) for fold in in_threads(spark, prepare, folds) for i in range(len(points))]
    rows = longest_first(spark, run, tasks, [points[i] for _, i in tasks])
    table = spark.createDataFrame(
        rows, "tentativa int, fold int, parametros map<string,string>, treino double, validacao double"
    )
    means = table.groupBy("tentativa").agg(
        F.any_value("parametros").alias("parametros"),
        F.avg("validacao").alias("mae_validacao_media"),
        F.stddev_pop("validacao").alias("mae_validacao_dp"),
        F.avg("treino").alias("mae_treino_media"),
    )
    # one row per draw
    w = Window.orderBy(F.asc_nulls_last("mae_validacao_media"))
    return means.withColumn("posicao", F.rank().over(w)).orderBy("posicao", "tentativa")


def best_point(ranked: DataFrame, space: Mapping[str, Sequence]) -> dict:
    """Setting of the first row, with the types of the space."""
    row = ranked.orderBy("posicao", "tentativa").first()
    return {k: type(v[0])(row["parametros"][k]) for k, v in space.items()}


def cv_errors(scored: DataFrame, target: str, predicted: str, folds: DataFrame,
              year: str = "ano") -> DataFrame:
    """MAE, RMSE and R2 per fold and role of rows that already carry a prediction.

    Errors are reduced to sums per year first, so the fold table joins a yearly
    table and rows are not copied per fold.
    """
    y, p = F.col(target), F.col(predicted)
    yearly = scored.where(y.isNotNull() & p.isNotNull()).groupBy(year).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(y - p)).alias("ae"),
        F.sum((y - p) * (y - p)).alias("se"), F.avg(y).alias("m"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("ss"),
    )
    joined = yearly.join(folds, year)
    centre = F.sum(F.col("n") * F.col("m")) / F.sum("n")
    inner = F.sum("ss") + F.sum(F.col("n") * F.col("m") * F.col("m")) - F.sum("n") * centre * centre
    return joined.groupBy("fold", "role").agg(
        F.sum("n").alias("n"), (F.sum("ae") / F.sum("n")).alias("mae"),
        F.sqrt(F.sum("se") / F.sum("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum("se"), inner)).alias("r2"),
    )


def cross_validate(
    train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
    build: models.Builder, n_splits: int = 4, year: str = "ano",
) -> DataFrame:
    """Errors per fold and role (treino / validacao) of a refitted model."""
    folds = fold_years(year_folds(train, n_splits, year), year)

    def run(fold: tuple) -> list[tuple]:
        number, early, late = fold
        inner = rows_of(train, early, year)
        preparation = fit_preparation(inner, numeric, categorical)
        model = models.fit(inner, target, preparation, build)
        out = []
        for role, part in (("treino", inner), ("validacao", rows_of(train, late, year))):
            e = _errors(model, part, preparation.input_columns(), target)
            out.append((number, role, e["mae"], e["rmse"], e["r2"]))
        return out

    rows = [r for part in in_threads(train.sparkSession, run, folds) for r in part]
    return train.sparkSession.createDataFrame(
        rows, "fold int, role string, mae double, rmse double, r2 double"
    )


def cv_summary(errors: DataFrame) -> DataFrame:
    """Mean and population sd of the validation errors, means of the training ones."""
    valid, learn = F.col("role") == "validacao", F.col("role") == "treino"
    out = [F.count_distinct("fold").alias("n_folds")]
    for m in ("mae", "rmse", "r2"):
        v = F.when(valid, F.col(m))
        out += [F.avg(v).alias(f"{m}_validacao_media"), F.stddev_pop(v).alias(f"{m}_validacao_dp")]
    out += [F.avg(F.when(learn, F.col(m))).alias(f"{m}_treino_media") for m in ("mae", "r2")]
    return errors.agg(*out)


def cv_diagnosis(summary: DataFrame) -> DataFrame:
    """First matching reading of the gap, the spread and the explained share."""
    say = settings.CV_DIAGNOSIS
    gap = F.col("mae_validacao_media") - F.col("mae_treino_media")
    sd = F.col("mae_validacao_dp")
    text = (
        F.when((gap > 1.5) | (sd > 1.5), F.lit(say["unstable"]))
        .when((gap > 0.6) | (sd > 0.8), F.lit(say["overfit"]))
        .when(F.col("r2_validacao_media") < 0.2, F.lit(say["underfit"]))
        .otherwise(F.lit(say["stable"]))
    )
    return summary.select(
        half_even(gap, 6).alias("diferenca_mae"), half_even(sd, 6).alias("dp_mae"),
        text.alias("diagnostico"),
    )


def learning_curve(
    train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
    build: models.Builder, order: Sequence[str], n_splits: int = 4, steps: int = 5,
    lowest: float = 0.3, year: str = "ano",
) -> DataFrame:
    """Error against training size; each size takes the first rows in time order."""
    folds = fold_years(year_folds(train, n_splits, year), year)
    numbered = materialize(number_rows(train, [year, *order], "_row"), "curve")
    counts = {r[year]: r["n"] for r in
              numbered.groupBy(year).agg(F.count(F.lit(1)).alias("n")).collect()}
    smallest = min(sum(counts.get(y, 0) for y in early) for _, early, _ in folds)
    gap = (1.0 - lowest) / (steps - 1)
    sizes = sorted({max(1, int((lowest + gap * i) * smallest + 1e-9)) for i in range(steps)})

    # folds all start at the first year, so one size is the same rows in each of them
    def run(size: int) -> list[tuple]:
        inner = numbered.where(F.col("_row") < size)
        preparation = fit_preparation(inner, numeric, categorical)
        model = models.fit(inner, target, preparation, build)
        scored = models.score(model, numbered, preparation.input_columns())
        gap = F.abs(F.col(target) - F.col(models.PREDICTION))
        found = scored.agg(
            F.avg(F.when(F.col("_row") < size, gap)).alias("learnt"),
            *[F.avg(F.when(F.col(year).isin(late), gap)).alias(f"f{number}")
              for number, _, late in folds],
        ).first()
        return [(size, number, found["learnt"], found[f"f{number}"]) for number, _, _ in folds]

    rows = [r for part in in_threads(train.sparkSession, run, sizes) for r in part]
    table = train.sparkSession.createDataFrame(
        rows, "tamanho int, fold int, treino double, validacao double"
    )
    return table.groupBy("tamanho").agg(
        F.avg("treino").alias("mae_treino_media"), F.stddev_pop("treino").alias("mae_treino_dp"),
        F.avg("validacao").alias("mae_validacao_media"),
        F.stddev_pop("validacao").alias("mae_validacao_dp"),
    ).orderBy("tamanho")


def permutation_importance(
    model: PipelineModel, rows: DataFrame, target: str, columns: Sequence[str],
    ids: Sequence[str], repeats: int = 8, seed: int = models.SEED, keep: Sequence[str] = (),
) -> DataFrame:
    """Mean drop in R2 when one input column is shuffled.

    ``keep`` names further inputs of the model that stay as they are. A repeat
    numbers the rows in two orders, by id and by a hash of the id, and joins them on
    the number: one permutation that serves every column.
    """
    inputs = [*columns, *keep]
    base = _errors(model, rows, inputs, target)["r2"]
    used = list(dict.fromkeys([*ids, target, *inputs]))
    own = materialize(number_rows(rows.select(*used), list(ids), "_row"), "own")
    parts = []
    for r in range(max(3, repeats)):
        mixed = own.select(*ids, *columns).withColumn("_h", F.xxhash64(F.lit(seed + r), *ids))
        other = number_rows(mixed, ["_h", *ids], "_row").select(
            "_row", *[F.col(c).alias(f"mix_{c}") for c in columns]
        )
        # one variant of the row per column, that column taken from the other row
        variants = F.array(*[
            F.struct(
                F.lit(c).alias("coluna"),
                *[F.col(f"mix_{x}" if x == c else x).alias(x) for x in columns],
            )
            for c in columns
        ])
        mixed_rows = own.join(other, "_row").select(target, *keep, F.inline(variants))
        scored = models.score(model, mixed_rows, inputs)
        parts.append(
            regression_metrics(scored, target, models.PREDICTION, ["coluna"])
            .select("coluna", F.lit(r).alias("repeticao"), "r2")
        )
    table = reduce(DataFrame.unionByName, parts)
    drop = F.lit(base) - F.col("r2")
    return table.groupBy("coluna").agg(
        F.avg(drop).alias("importancia"), F.stddev_pop(drop).alias("dp"),
        F.count(F.lit(1)).alias("repeticoes"),
    ).orderBy(F.desc("importancia"), "coluna")


def run_campaign(
    train: DataFrame, test: DataFrame, target: str, ids: Sequence[str],
    numeric: Sequence[str], categorical: Sequence[str],
    plan: Sequence[tuple[str, str, Mapping]], tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fit, evaluate and log each (name, algorithm, parameters) of a plan.

    All fits share one preparation and its stored rows, and the neighbour runs one
    search: the neighbours of a small k are the first ones of a larger k. Returns the
    run table; the parent row holds the shared settings.
    """
    spark = train.sparkSession
    preparation = fit_preparation(train, numeric, categorical)
    inputs = preparation.input_columns()
    parent = runs.new_run("campanha", None, {"dados": {"colunas": len(inputs)}}, {}, tags)
    features = fit_features(train, preparation)
    learn, check = (
        materialize(features.transform(r).select(*ids, target, FEATURES), "campaign") for r in (train, test))
    asked = [params["k"] for _, algorithm, params in plan if algorithm == "knn"]
    if asked:
        query, known = (r.withColumn("vec", vector_to_array(FEATURES)) for r in (check, learn))
        near = materialize(nearest(query, known, "vec", ids, ids, max(asked), [target]), "near")

    def run(item: tuple) -> tuple:
        name, algorithm, params = item
        if algorithm == "knn":
            first = near.where(F.col("ordem") <= params["k"])
            found = neighbour_mean(first, ids, target, params["weights"])
            scored = check.select(*ids, target).join(found, list(ids))
            row = regression_metrics(scored, target, models.PREDICTION).first()
            found = {"mae": row["mae"], "rmse": row["rmse"], "r2": row["r2"]}
        else:
            build = boosting_from(params) if algorithm == "boosting" else models.tree(
                params["maxDepth"], params["minInstancesPerNode"]
            )
            found = _errors(build(learn, target).fit(learn), check, [FEATURES], target)
        metrics = {f"test_{k}": v for k, v in found.items()}
        return runs.new_run(name, algorithm, params, metrics, tags, parent[0])

    done = longest_first(spark, run, list(plan), [params for _, _, params in plan])
    return runs.runs_table(spark, [parent, *done])


def campaign_plan(named: Mapping[str, Mapping[str, Mapping]] = settings.CAMPAIGN) -> list[tuple]:
    """(name, algorithm, parameters) of every named run."""
    return [
        (name, algorithm, params)
        for algorithm, listed in named.items()
        for name, params in listed.items()
    ]


def campaign_summary(table: DataFrame) -> DataFrame:
    """Child runs by test MAE, and the best one of each algorithm."""
    def metric(name: str) -> Column:
        return F.try_element_at("metricas", F.lit(name)).alias(name)

    rows = table.where(F.col("parent_id").isNotNull()).select(
        "nome", "algoritmo", "parametros", metric("test_mae"), metric("test_rmse"),
        metric("test_r2"),
    )
    # one row per fit
    w = Window.partitionBy("algoritmo").orderBy("test_mae", "nome")
    return rows.withColumn("melhor_do_algoritmo", F.row_number().over(w) == 1).orderBy(
        "test_mae", "nome"
    )
