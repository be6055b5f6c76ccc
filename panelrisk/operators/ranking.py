"""Top-k, best per group, per-row extremes, cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelrisk.functions.text import fixed, key_values, template
from panelrisk.storage import materialize


def top_rows(df: DataFrame, score: str, n: int, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(n)


def best_per_group(
    df: DataFrame, group: str, error: str, ties: Sequence[str]
) -> DataFrame:
    """Row with the smallest error in each group, and whether it is the best of all.

    The arg-min is an aggregate with map-side combine, so a group of any size
    costs one row per task. The winners are written once for the overall best.
    """
    rest = [c for c in df.columns if c not in (group, error, *ties)]
    row = F.struct(error, *ties, *rest)
    best = materialize(
        df.where(F.col(error).isNotNull())
        .groupBy(group).agg(F.min_by(row, F.struct(error, *ties)).alias("b"))
        .select(group, "b.*"),
        "best",
    )
    first = F.min(F.struct(F.col(error), F.col(group).alias("g")))
    top = best.select(first.alias("t")).select("t.g").scalar()
    return best.withColumn("melhor_geral", F.col(group) == top)


def row_top_indicators(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], high: int = 3, low: int = 2
) -> DataFrame:
    """Names of the largest and smallest indicators of each row, nulls left out."""
    named = F.array(*[
        F.struct(F.col(c).cast("double").alias("v"), F.lit(i).alias("i"), F.lit(c).alias("name"))
        for i, c in enumerate(columns)
    ])
    present = F.filter(named, lambda x: x["v"].isNotNull())
    rising = F.array_sort(present)
    # equal values keep the column order in both directions
    falling = F.array_sort(
        F.transform(present, lambda x: F.struct((-x["v"]).alias("v"), x["i"], x["name"]))
    )

    def names(a: Column, n: int) -> Column:
        return F.array_join(F.transform(F.slice(a, 1, n), lambda x: x["name"]), ",")

    return df.select(*ids, names(falling, high).alias("maiores"), names(rising, low).alias("menores"))


def action_cards(latest: DataFrame, actions: Sequence[tuple]) -> DataFrame:
    """Cards whose text carries a value of the latest year; missing counts as zero."""
    cards = []
    for order, (urgency, title, text, column, digits) in enumerate(actions, 1):
        value = (
            template(text, fixed(F.coalesce(F.col(column), F.lit(0.0)), digits))
            if column else F.lit(text)
        )
        cards.append(F.struct(
            F.lit(order).alias("ordem"), F.lit(urgency).alias("urgencia"),
            F.lit(title).alias("titulo"), value.alias("indicador"),
        ))
    return latest.select(F.inline(F.array(*cards)))


def format_params(algorithm: Column, by_algorithm: dict[str, Sequence[tuple[str, Column]]]) -> Column:
    """Short text of the parameters that an algorithm uses."""
    out = None
    for name, pairs in by_algorithm.items():
        text = key_values(pairs)
        out = F.when(algorithm == name, text) if out is None else out.when(algorithm == name, text)
    return out.otherwise(F.lit(""))
