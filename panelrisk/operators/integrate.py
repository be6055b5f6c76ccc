"""Yearly tables, the joins between panel and context, and the unit-year fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.functions.columns import half_even, weighted_index
from panelrisk.operators.cleaning import dedup_rows
from panelrisk.operators.joining import lookup_join, with_suffixes, without_clashes


def yearly_means(
    df: DataFrame, columns: Sequence[str], year: str = "ano", digits: int = 2
) -> DataFrame:
    """Mean of each column per year, nulls skipped."""
    return df.groupBy(year).agg(*[half_even(F.avg(c), digits).alias(c) for c in columns])


def first_per_year(
    df: DataFrame, value: str, order: Sequence[str], year: str = "ano"
) -> DataFrame:
    """First non-null value of each year in the given order."""
    key = F.struct(*order)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(year).agg(F.min_by(value, key).alias(value))
    )


def lookup_first(
    yearly: DataFrame, detail: DataFrame, value: str, order: Sequence[str], year: str = "ano"
) -> DataFrame:
    """Attach the first value of each year; years without one keep null."""
    return lookup_join(yearly, first_per_year(detail, value, order, year), [year], "left")


def integrate_years(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    weights: Mapping[str, float],
    suffixes: tuple[str, str] = ("_socio", "_educ"),
    index: str = "indice_risco",
) -> DataFrame:
    """Inner join of two yearly tables and their composite index."""
    left, right = with_suffixes(left, right, on, suffixes)
    both = left.join(right, list(on))
    return both.withColumn(index, weighted_index(weights, both.columns, 2))


def integrate_fact(
    fact: DataFrame,
    yearly: DataFrame,
    weights: Mapping[str, float],
    year: str = "ano",
    index: str = "indice_risco",
    distinct: bool = False,
) -> DataFrame:
    """Yearly rates copied to each unit-year, composite index, dedup.

    Many-to-one: a year that occurs twice on the yearly side is an error. Years
    missing on either side are dropped. ``distinct`` says that the fact rows carry
    an id or key and cannot repeat, so that no dedup shuffle is planned.
    """
    joined = lookup_join(fact, without_clashes(fact, yearly, [year]), [year])
    out = joined.withColumn(index, weighted_index(weights, joined.columns, 2))
    return out if distinct else dedup_rows(out)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Rows, distinct ids and whether they agree."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(column).alias("n_ids"),
    ).withColumn("unico", F.col("n_rows") == F.col("n_ids"))


def union_splits(parts: Mapping[str, DataFrame], name: str = "split") -> DataFrame:
    """Stack tables that may lack columns, tagged by their key."""
    out = None
    for label, df in parts.items():
        tagged = df.withColumn(name, F.lit(label))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def distinct_on(df: DataFrame, keys: Sequence[str], keep: Mapping[str, Column]) -> DataFrame:
    """One row per key; each kept column is a deterministic aggregate."""
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in keep.items()])
