"""Tables that the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelrisk import settings
from panelrisk.functions.columns import level_of, period_of, weighted_index
from panelrisk.operators.integrate import integrate_fact, integrate_years, yearly_means
from panelrisk.operators.ordering import number_rows
from panelrisk.sources import panel as recipe
from panelrisk.sources.panel import context, panel

UNIT_KEYS = ["ent", "ano"]
FACT_COLUMNS = [*recipe.INDICATORS, *recipe.CONTEXT_RATES]


def with_period(df: DataFrame) -> DataFrame:
    return df.withColumn("periodo", period_of("ano", recipe.PERIODS, recipe.PERIODS_LAST))


def with_levels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f"risco_{s}": level_of(f"aband_{s}", settings.RATE_CUTS, settings.RATE_LABELS)
        for s in ("ef", "em")
    })


def context_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return with_period(yearly_means(context(spark, folder), recipe.CONTEXT_RATES))


def panel_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return with_period(yearly_means(panel(spark, folder), recipe.INDICATORS))


def year_integrated(spark: SparkSession, folder: str) -> DataFrame:
    return integrate_years(
        context_yearly(spark, folder), panel_yearly(spark, folder), ["ano", "periodo"],
        recipe.INDEX_WEIGHTS,
    )


def unit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Panel with period and levels, without the row id."""
    return with_levels(with_period(panel(spark, folder)))


def unit_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Panel with period, levels and the dense row id."""
    return number_rows(unit_rows(spark, folder), UNIT_KEYS, "id_linha")


def joined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Unit rows joined with the yearly context, for statistics that need no row id."""
    return integrate_fact(
        unit_rows(spark, folder), context_yearly(spark, folder), recipe.INDEX_WEIGHTS,
        distinct=True,
    )


def fact_integrated(spark: SparkSession, folder: str) -> DataFrame:
    return integrate_fact(
        unit_fact(spark, folder), context_yearly(spark, folder), recipe.INDEX_WEIGHTS,
        distinct=True,
    )


def risk_scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = panel(spark, folder)
    return rows.withColumn("score", weighted_index(recipe.SCORE_WEIGHTS, rows.columns, 1))


def formula_prediction() -> "F.Column":
    """Linear stand-in for a model, so that scoring plans have an exact answer."""
    return (
        F.lit(1.0) + F.lit(0.25) * F.coalesce(F.col("tdi_em"), F.lit(25.0))
        + F.lit(0.5) * F.col("aband_ef")
    )


def formula_scored(
    spark: SparkSession, folder: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Panel rows with a target and the formula prediction."""
    return panel(spark, folder, first, last).where(F.col("aband_em").isNotNull()).withColumn(
        "pred", formula_prediction()
    )
