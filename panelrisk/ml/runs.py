"""Append-only table of training runs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "run_id string, parent_id string, nome string, algoritmo string,"
    " parametros map<string,string>, metricas map<string,double>, marcas map<string,string>,"
    " quando timestamp"
)


def flatten(params: Mapping, prefix: str = "") -> dict[str, str]:
    """Nested parameters as dotted keys."""
    out: dict[str, str] = {}
    for key, value in params.items():
        name = f"{prefix}.{key}" if prefix else str(key)
        if isinstance(value, Mapping):
            out |= flatten(value, name)
        else:
            out[name] = str(value)
    return out


def new_run(
    name: str, algorithm: str | None, params: Mapping, metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None, parent: str | None = None,
) -> tuple:
    numbers = {k: float(v) for k, v in metrics.items() if v is not None}
    return (uuid.uuid4().hex, parent, name, algorithm, flatten(params), numbers,
            dict(tags or {}), datetime.now(timezone.utc))


def runs_table(spark: SparkSession, runs: Sequence[tuple]) -> DataFrame:
    """One row per fit made by the driver."""
    return spark.createDataFrame(list(runs), SCHEMA)
