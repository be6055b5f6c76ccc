"""Train-only imputation and scaling, kept as Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from panelrisk.operators.ordering import column_quantiles
from panelrisk.settings import MISSING_LABEL

FEATURES = "features"


def split_columns(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns by declared type, without the excluded ones."""
    numeric, categorical = [], []
    for f in df.schema:
        if f.name not in exclude:
            (numeric if isinstance(f.dataType, NumericType) else categorical).append(f.name)
    return numeric, categorical


def medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; a column without values is filled with zero."""
    if not columns:
        return {}
    table = column_quantiles(train, list(columns), (0.5,), ("q",))
    found = {r["indicator"]: r["q"] for r in table.collect()}  # one row per column
    return {c: found.get(c, 0.0) for c in columns}


def modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties."""
    if not columns:
        return {}
    text = train.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        text.unpivot([], list(columns), "indicator", "value").where(F.col("value").isNotNull())
        .groupBy("indicator", "value").agg(F.count(F.lit(1)).alias("_n"))
    )
    best = counts.groupBy("indicator").agg(
        F.min_by("value", F.struct(-F.col("_n"), F.col("value"))).alias("value")
    )
    found = {r["indicator"]: r["value"] for r in best.collect()}  # one row per column
    return {c: found.get(c, MISSING_LABEL) for c in columns}


def fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def scales(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population sd per column; a constant column is only centred."""
    if not columns:
        return {}
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def standardize(df: DataFrame, by: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in by.items()}
    )


@dataclass(frozen=True)
class Preparation:
    """Values learnt on the training rows."""

    medians: dict[str, float]
    scales: dict[str, tuple[float, float]]
    modes: dict[str, str]

    def stages(self) -> list:
        """Impute, scale, one-hot, assemble. Values not seen in training are all zeros.

        An empty text counts as missing: the encoder takes no empty name.
        """
        parts = [
            f"(coalesce(cast({_name(c)} as double), {_sql(v)}) - {_sql(self.scales[c][0])})"
            f" / {_sql(self.scales[c][1])} as {_name(f'z_{c}')}"
            for c, v in self.medians.items()
        ]
        parts += [
            f"coalesce(nullif(cast({_name(c)} as string), ''), {_text(v or MISSING_LABEL)})"
            f" as {_name(f's_{c}')}"
            for c, v in self.modes.items()
        ]
        out: list = [SQLTransformer(statement=f"select *, {', '.join(parts)} from __THIS__")]
        inputs = [f"z_{c}" for c in self.medians]
        if self.modes:
            cats = list(self.modes)
            out.append(StringIndexer(
                inputCols=[f"s_{c}" for c in cats], outputCols=[f"i_{c}" for c in cats],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ))
            out.append(OneHotEncoder(
                inputCols=[f"i_{c}" for c in cats], outputCols=[f"o_{c}" for c in cats],
                dropLast=True,
            ))
            inputs += [f"o_{c}" for c in cats]
        out.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
        return out

    def input_columns(self) -> list[str]:
        return [*self.medians, *self.modes]

    def helper_columns(self) -> list[str]:
        cats = list(self.modes)
        return [FEATURES, *[f"z_{c}" for c in self.medians],
                *[f"{p}_{c}" for c in cats for p in ("s", "i", "o")]]


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(v: str) -> str:
    """String literal that reads back as ``v`` whatever it holds."""
    return "'" + "".join(c if c.isalnum() or c == " " else f"\\u{ord(c):04x}" if ord(c) < 0x10000
                         else f"\\U{ord(c):08x}" for c in v) + "'"


def _sql(v: float) -> str:
    return f"cast('{float(v)!r}' as double)"


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> Preparation:
    mid = medians(train, numeric)
    return Preparation(mid, scales(fill(train, mid), list(numeric)), modes(train, categorical))


def fit_features(train: DataFrame, preparation: Preparation) -> PipelineModel:
    """Only the preparation, for distance and clustering operators."""
    return Pipeline(stages=preparation.stages()).fit(train)


def feature_array(df: DataFrame, model: PipelineModel, name: str = "vec") -> DataFrame:
    """Add the prepared features of each row as array<double>."""
    return model.transform(df).select(*df.columns, vector_to_array(FEATURES).alias(name))
