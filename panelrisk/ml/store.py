"""A fitted pipeline together with what is needed to use it again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from panelrisk.ml.models import score
from panelrisk.ml.runs import flatten

META = (
    "alvo string, entradas array<string>, parametros map<string,string>, anos array<int>,"
    " ano_corte int, ajustado_em timestamp"
)


@dataclass(frozen=True)
class StoredModel:
    model: PipelineModel
    target: str
    inputs: list[str]
    params: dict[str, str]
    years: list[int]
    cutoff: int | None

    def predict(self, rows: DataFrame, name: str = "pred") -> DataFrame:
        return score(self.model, rows, self.inputs, name)


def save_model(
    spark: SparkSession, model: PipelineModel, path: str, target: str, inputs: Sequence[str],
    params: Mapping, years: Sequence[int], cutoff: int | None = None,
) -> None:
    model.write().overwrite().save(f"{path}/model")
    row = (target, list(inputs), flatten(params), [int(y) for y in years], cutoff,
           datetime.now(timezone.utc))
    spark.createDataFrame([row], META).write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> StoredModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    return StoredModel(
        PipelineModel.load(f"{path}/model"), meta["alvo"], list(meta["entradas"]),
        dict(meta["parametros"]), list(meta["anos"]), meta["ano_corte"],
    )
