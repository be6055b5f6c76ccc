"""Regressors, scoring, comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelrisk.ml.prep import FEATURES, Preparation, feature_array, fit_features, fit_preparation
from panelrisk.ml.neighbors import knn_regress
from panelrisk.operators.cleaning import require_columns
from panelrisk.operators.quality import null_shares
from panelrisk.operators.stats import regression_metrics
from panelrisk.storage import materialize, new_path

PREDICTION = "pred"
SEED = 42


def boosting(max_depth=5, max_iter=200, step=0.08, min_leaf=20, seed=SEED):
    """Gradient-boosted trees. Spark has no L2 term and no leaf-count limit."""
    return lambda train, target: GBTRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol=PREDICTION, seed=seed,
        maxDepth=max_depth, maxIter=max_iter, stepSize=step, minInstancesPerNode=min_leaf,
    )


def tree(max_depth=4, min_leaf=2, seed=SEED, leaf_col=""):
    return lambda train, target: DecisionTreeRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol=PREDICTION, seed=seed,
        maxDepth=max_depth, minInstancesPerNode=min_leaf, leafCol=leaf_col,
    )


def ridge(alpha=1.0):
    """Least squares with an L2 penalty of ``alpha`` on the coefficients.

    Spark scales the label by its population sd and divides the loss by the
    number of rows, so the penalty is scaled the same way.
    """

    def build(train: DataFrame, target: str):
        row = train.agg(F.stddev_pop(target).alias("s"), F.count(target).alias("n")).first()
        return LinearRegression(
            featuresCol=FEATURES, labelCol=target, predictionCol=PREDICTION,
            elasticNetParam=0.0, standardization=False, solver="normal",
            regParam=alpha * (row["s"] or 1.0) / max(row["n"], 1),
        )

    return build


Builder = Callable[[DataFrame, str], object]


def fit(train: DataFrame, target: str, preparation: Preparation, build: Builder) -> PipelineModel:
    stages = [*preparation.stages(), build(train, target)]
    return Pipeline(stages=stages).fit(train)


def score(model: PipelineModel, rows: DataFrame, inputs: Sequence[str], name: str = PREDICTION,
          keep: Sequence[str] = ()) -> DataFrame:
    """Rows with their prediction; fails early where an input column is missing."""
    require_columns(rows, inputs)
    return model.transform(rows).select(*rows.columns, *keep, F.col(PREDICTION).alias(name))


def knn_predict(
    train: DataFrame, test: DataFrame, target: str, preparation: Preparation,
    ids: Sequence[str], k: int = 5, weights: str = "distance",
) -> DataFrame:
    """Nearest-neighbour regression on the prepared features."""
    model = fit_features(train, preparation)
    return knn_regress(
        feature_array(test, model), feature_array(train, model), "vec", list(ids), list(ids),
        target, k, weights,
    ).select(*ids, PREDICTION)


def compare(
    train: DataFrame, test: DataFrame, target: str, ids: Sequence[str],
    numeric: Sequence[str], categorical: Sequence[str],
    builders: Mapping[str, Builder], knn: Mapping[str, int] | None = None,
) -> DataFrame:
    """One stacked prediction table (modelo, ids, target, pred) on the test rows."""
    preparation = fit_preparation(train, numeric, categorical)
    parts = []
    for name, build in builders.items():
        model = fit(train, target, preparation, build)
        scored = score(model, test, preparation.input_columns())
        parts.append(scored.select(F.lit(name).alias("modelo"), *ids, target, PREDICTION))
    for name, k in (knn or {}).items():
        near = knn_predict(train, test, target, preparation, ids, k)
        joined = test.select(*ids, target).join(near, list(ids))
        parts.append(joined.select(F.lit(name).alias("modelo"), *ids, target, PREDICTION))
    return materialize(reduce(DataFrame.unionByName, parts), "predictions")


def metrics_table(predictions: DataFrame, target: str) -> DataFrame:
    return regression_metrics(predictions, target, PREDICTION, ["modelo"]).orderBy("mae", "modelo")


def missing_impact(
    train: DataFrame, test: DataFrame, target: str,
    numeric: Sequence[str], categorical: Sequence[str], limit: float, alpha: float = 1.0,
) -> DataFrame:
    """Ridge error with all columns and without those too empty on the training rows."""
    shares = null_shares(train, [*numeric, *categorical]).collect()  # one row per column
    dropped = {r["coluna"] for r in shares if r["frac_ausentes"] > limit}
    parts = []
    for label, drop in (("todas", set()), ("sem_esparsas", dropped)):
        num = [c for c in numeric if c not in drop]
        cat = [c for c in categorical if c not in drop]
        preparation = fit_preparation(train, num, cat)
        model = fit(train, target, preparation, ridge(alpha))
        scored = score(model, test, preparation.input_columns())
        parts.append(
            regression_metrics(scored, target, PREDICTION)
            .select(F.lit(label).alias("variante"), F.lit(len(num) + len(cat)).alias("n_colunas"),
                    F.lit(",".join(sorted(drop))).alias("retiradas"), "n", "mae", "rmse", "r2")
        )
    return reduce(DataFrame.unionByName, parts)


def coefficients(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Intercept and coefficients of a fitted linear model by feature name."""
    spark = rows.sparkSession
    linear = model.stages[-1]
    names = feature_names(model, rows)
    table = [("intercept", float(linear.intercept))]
    table += [(names[i], float(v)) for i, v in enumerate(linear.coefficients)]
    return spark.createDataFrame(table, "termo string, valor double")


def tree_leaf_table(
    model: PipelineModel, rows: DataFrame, target: str, columns: Sequence[str], leaf: str
) -> DataFrame:
    """One row per leaf: rows, mean target and the range of each input column."""
    placed = model.transform(rows)
    ranges = [f(c).alias(f"{p}_{c}") for c in columns for p, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy(F.col(leaf).cast("int").alias("folha")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias(f"media_{target}"), *ranges
    )


def feature_names(model: PipelineModel, rows: DataFrame) -> list[str]:
    """Names of the assembled features, in their order."""
    attrs = model.transform(rows.limit(1)).schema[FEATURES].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]


def tree_nodes(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Nodes of a fitted tree (no, esquerda, direita, coluna, corte, menor, previsao, n), read from its stored form.

    Leaves have no children, column and threshold. ``menor`` is the child of rows whose
    prepared column is at most the threshold. The columns of a category are 0 or 1;
    Spark splits them by the values that go left, which a threshold of one half says as well.
    """
    path = new_path(spark, "tree")
    model.stages[-1].write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    inner, values = F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")
    number = F.col("split.numCategories") < 0
    low_left = number | F.array_contains(values, F.lit(0.0))
    name = F.array(*map(F.lit, names))[F.col("split.featureIndex")]
    return nodes.select(
        F.col("id").alias("no"), F.when(inner, F.col("leftChild")).alias("esquerda"),
        F.when(inner, F.col("rightChild")).alias("direita"), F.when(inner, name).alias("coluna"),
        F.when(inner & number, F.get(values, F.lit(0))).when(inner, 0.5).alias("corte"),
        F.when(inner & low_left, F.col("leftChild")).when(inner, F.col("rightChild")).alias("menor"),
        F.col("prediction").alias("previsao"), F.col("rawCount").alias("n"))


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Rules of a tree: (folha, passo, coluna, lado, corte, previsao, n), one row per leaf and step.

    Leaves are numbered from 0 in the order of their nodes, which is how Spark numbers
    them. The walk goes from the leaves to the root, one join per level. A tree that is
    a single leaf has one row of step 0 without a condition.
    """
    spark = nodes.sparkSession
    up = nodes.where("esquerda is not null").select(
        F.col("no").alias("_up"), "coluna", "corte",
        F.explode(F.array("esquerda", "direita")).alias("_at"), "menor",
    ).withColumn("lado", F.when(F.col("_at") == F.col("menor"), "<=").otherwise(">")).drop("menor")
    up = materialize(up, "tree-up")
    leaves = nodes.where("esquerda is null").select(
        (F.row_number().over(Window.orderBy("no")) - 1).alias("folha"),  # a row per leaf of one tree
        "previsao", "n", F.col("no").alias("_at"))
    at, levels = materialize(leaves, "tree-leaves"), []
    while True:
        step = materialize(at.join(up, "_at"), "tree-level")
        if step.isEmpty():
            break
        levels.append(step.withColumn("_back", F.lit(len(levels))))
        at = step.select("folha", "previsao", "n", F.col("_up").alias("_at"))
    rest = ["folha", "previsao", "n"]
    if not levels:
        empty = "folha int, passo int, coluna string, lado string, corte double, previsao double, n long"
        alone = leaves.select(*rest, F.lit(0).alias("passo"))
        return spark.createDataFrame([], empty).unionByName(alone, allowMissingColumns=True)
    whole = reduce(DataFrame.unionByName, levels)
    depth = F.max("_back").over(Window.partitionBy("folha"))
    return whole.select(
        "folha", (depth - F.col("_back") + 1).cast("int").alias("passo"), "coluna", "lado", "corte", "previsao", "n")


def tree_shape(paths: DataFrame) -> DataFrame:
    """Depth, number of leaves and of rows the tree was fitted on."""
    leaves = paths.groupBy("folha").agg(F.max("passo").alias("d"), F.first("n").alias("n"))
    return leaves.agg(
        F.max("d").alias("profundidade"), F.count(F.lit(1)).alias("folhas"), F.sum("n").alias("n"))


def tree_rules(paths: DataFrame) -> DataFrame:
    """One readable rule per leaf."""
    condition = F.format_string("%s %s %.4f", "coluna", "lado", "corte")
    listed = F.array_sort(F.collect_list(F.struct("passo", condition.alias("t"))))
    steps = F.when(F.first("coluna").isNull(), F.lit("sempre")).otherwise(
        F.array_join(F.transform(listed, lambda s: s["t"]), " e "))
    return paths.groupBy("folha").agg(steps.alias("regra"), F.first("previsao").alias("previsao"), F.first("n").alias("n"))


def apply_paths(paths: DataFrame, rows: DataFrame, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Rows with the leaf (``folha_regra``) and prediction (``pred_regra``) that the rules give.

    The rules are read once, two to the depth of the tree at most, and become one expression.
    """
    vec, at = F.col("_vec"), {name: i for i, name in enumerate(names)}
    rules: dict[int, tuple[Column, float]] = {}
    for r in paths.orderBy("folha", "passo").collect():
        true, _ = rules.get(r["folha"], (F.lit(True), 0.0))
        if r["coluna"] is not None:
            x = vec[at[r["coluna"]]]
            true = true & (x <= r["corte"] if r["lado"] == "<=" else x > r["corte"])
        rules[r["folha"]] = (true, r["previsao"])
    leaf, value = F.lit(None).cast("int"), F.lit(None).cast("double")
    for number, (true, p) in rules.items():
        leaf, value = F.when(true, number).otherwise(leaf), F.when(true, F.lit(p)).otherwise(value)
    prepared = PipelineModel(model.stages[:-1])
    return feature_array(rows, prepared, "_vec").select(
        *rows.columns, leaf.alias("folha_regra"), value.alias("pred_regra"))


def tree_text(model: PipelineModel) -> str:
    return model.stages[-1].toDebugString


def compare_text(metrics: DataFrame) -> DataFrame:
    """A sentence per model and its place by error."""
    best = metrics.agg(F.min(F.struct("mae", "modelo")).alias("b")).select("b.modelo").scalar()
    note = F.when(F.col("modelo") == best, F.lit("menor erro medio")).otherwise(F.lit("comparado"))
    return metrics.select(
        "modelo",
        F.format_string(
            "%s: MAE %.2f p.p., RMSE %.2f, R2 %.2f (%s)",
            F.col("modelo"), F.col("mae"), F.col("rmse"), F.coalesce("r2", F.lit(0.0)), note,
        ).alias("texto"),
    )
