"""K-means groups, their profiles and a two-dimensional projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from panelrisk.functions.columns import half_even
from panelrisk.ml.prep import FEATURES
from panelrisk.ml.tune import in_threads
from panelrisk.operators.ranking import row_top_indicators

CLUSTER = "cluster"
WORKERS = 8  # fits at the same time: each is many short jobs with gaps between them


def _fits(rows: DataFrame, points: Sequence[tuple[int, int]], workers: int = WORKERS) -> list[KMeansModel]:
    """A model for each (k, seed); fits run side by side over rows that should come from a stored table.

    They are not cached here: a fit of uncached rows decodes them once and keeps the
    vectors itself, in memory or on disk, a fit of cached rows decodes them in every turn.
    """
    return in_threads(
        rows.sparkSession,
        lambda p: KMeans(
            featuresCol=FEATURES, predictionCol=CLUSTER, k=p[0], seed=p[1], solver="row").fit(rows), points, workers)


def fit_kmeans(rows: DataFrame, k: int, seeds: Sequence[int]) -> KMeansModel:
    """Best of several starts by within-cluster cost, the first on ties."""
    return min(_fits(rows, [(k, seed) for seed in seeds]), key=lambda m: m.summary.trainingCost)


def choose_k(
    rows: DataFrame, ks: Sequence[int], seeds: Sequence[int]
) -> tuple[KMeansModel, list[tuple[int, float, float | None]]]:
    """Model with the largest silhouette, the smallest k on ties, and the curve.

    Curve rows are (k, inertia, silhouette). Spark's silhouette uses squared
    distances, so the chosen k may differ from a plain-distance silhouette.
    """
    evaluator = ClusteringEvaluator(featuresCol=FEATURES, predictionCol=CLUSTER)
    best, best_value, curve = None, None, []
    vectors = rows.select(FEATURES)
    models = _fits(vectors, [(k, seed) for k in ks for seed in seeds])
    for i, k in enumerate(ks):
        model = min(models[i * len(seeds):(i + 1) * len(seeds)], key=lambda m: m.summary.trainingCost)
        found = model.summary.k - sum(1 for n in model.summary.clusterSizes if n == 0)
        value = evaluator.evaluate(model.transform(vectors)) if found > 1 else None
        curve.append((k, float(model.summary.trainingCost), value))
        if best is None or (value is not None and (best_value is None or value > best_value)):
            best, best_value = model, value
    if best is None:
        raise ValueError("no k to try")
    return best, curve


def curve_table(rows: DataFrame, curve: Sequence[tuple], chosen: int) -> DataFrame:
    table = [(k, inertia, value, k == chosen) for k, inertia, value in curve]
    return rows.sparkSession.createDataFrame(
        table, "k int, inercia double, silhueta double, escolhido boolean"
    )


def assign(model: KMeansModel, features: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(features.transform(rows)).select(*rows.columns, CLUSTER)


def cluster_profiles(assigned: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean per cluster, and which cluster has the highest and lowest target."""
    table = assigned.groupBy(CLUSTER).agg(
        F.count(F.lit(1)).alias("n"), *[half_even(F.avg(c), 2).alias(c) for c in columns]
    )
    # one row per cluster
    high = F.row_number().over(Window.orderBy(F.desc_nulls_last(target), CLUSTER)) == 1
    low = F.row_number().over(Window.orderBy(F.asc_nulls_last(target), CLUSTER)) == 1
    known = F.col(target).isNotNull()
    return table.withColumns({"pior": high & known, "melhor": low & known})


def cluster_text(profiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Highest three and lowest two indicators of each group in a sentence."""
    names = row_top_indicators(profiles, [CLUSTER, "pior", "melhor"], columns)
    tail = F.when(F.col("pior"), F.lit(" (maior valor medio do alvo)")).when(
        F.col("melhor"), F.lit(" (menor valor medio do alvo)")
    ).otherwise(F.lit(""))
    text = F.format_string(
        "Grupo %d: mais altos %s; mais baixos %s%s",
        F.col(CLUSTER) + 1, F.col("maiores"), F.col("menores"), tail,
    )
    return names.select(CLUSTER, text.alias("texto"))


def pca_2d(train: DataFrame, rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """First two principal components; both sides already hold the feature vector.

    Features are centred first because the transformation does not centre. The
    sign of a component is arbitrary.
    """
    centre = StandardScaler(
        inputCol=FEATURES, outputCol="_centred", withMean=True, withStd=False
    ).fit(train)
    model = PCA(k=2, inputCol="_centred", outputCol="_pc").fit(centre.transform(train))
    xy = vector_to_array("_pc")
    return model.transform(centre.transform(rows)).select(
        *ids, xy[0].alias("pc1"), xy[1].alias("pc2")
    )
