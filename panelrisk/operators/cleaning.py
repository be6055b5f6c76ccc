"""Deduplication, casting, clipping, filters and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from panelrisk.functions.columns import clip, columns_with_prefix, half_even, to_number


def dedup_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated rows, null equal to null; optionally on a key subset."""
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def duplicate_counts(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and removed rows in one table."""
    cols = list(keys or df.columns)
    return (
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
             F.count(F.lit(1)).alias("n_distinct"))
        .withColumn("n_removed", F.col("n_rows") - F.col("n_distinct"))
    )


def cast_keys(df: DataFrame, year: str = "ano", ids: Sequence[str] = ()) -> DataFrame:
    casts = {year: F.col(year).cast("int"), **{c: F.col(c).cast("string") for c in ids}}
    return df.withColumns(casts)


def coerce_numeric(df: DataFrame, keep_text: Sequence[str]) -> DataFrame:
    """Every text column but ``keep_text`` to double, bad text to null."""
    text = [f.name for f in df.schema
            if isinstance(f.dataType, StringType) and f.name not in keep_text]
    return df.withColumns({c: to_number(c) for c in text}) if text else df


def clip_rates(
    df: DataFrame, prefixes: Sequence[str] = ("taxa_", "tdi_"), low: float = 0.0, high: float = 100.0
) -> DataFrame:
    found = columns_with_prefix(df, prefixes)
    return df.withColumns({c: clip(c, low, high) for c in found}) if found else df


def clean_rates(
    df: DataFrame,
    year: str = "ano",
    ids: Sequence[str] = (),
    prefixes: Sequence[str] = ("taxa_", "tdi_"),
) -> DataFrame:
    """Dedup, cast keys, coerce text, clip rates."""
    return clip_rates(coerce_numeric(cast_keys(dedup_rows(df), year, ids), ids), prefixes)


def year_filter(df: DataFrame, first: int, last: int, year: str = "ano") -> DataFrame:
    return df.where(F.col(year).between(first, last))


def last_n_years(df: DataFrame, n: int, year: str = "ano") -> DataFrame:
    """Rows of the last ``n`` distinct years present."""
    years = df.select(year).distinct().orderBy(F.desc_nulls_last(year)).limit(n)
    return df.where(F.col(year) >= years.agg(F.min(year)).scalar())


def any_limit_reached(limits: Mapping[str, float]) -> Column:
    """At least one column reaches its limit; a null never does."""
    return reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(c) >= F.lit(v), F.lit(False)) for c, v in limits.items()],
    )


def at_risk(
    df: DataFrame, limits: Mapping[str, float], ties: Sequence[str] = ()
) -> DataFrame:
    """Rows over a limit, highest first; ``ties`` complete the order."""
    order = [F.desc_nulls_last(c) for c in limits] + [F.asc(c) for c in ties]
    return df.where(any_limit_reached(limits)).orderBy(*order)


def drop_nulls(
    df: DataFrame, any_of: Sequence[str] = (), all_of: Sequence[str] = ()
) -> DataFrame:
    """Drop rows with a null in ``any_of``, or with nothing in ``all_of``."""
    if any_of:
        df = df.na.drop(how="any", subset=list(any_of))
    if all_of:
        df = df.na.drop(how="all", subset=list(all_of))
    return df


def identity_check(
    df: DataFrame, parts: Sequence[str], total: float = 100.0, tolerance: float = 0.15,
    year: str = "ano",
) -> DataFrame:
    """Complete rows per year, and how many miss the total by more than the tolerance."""
    gap = F.abs(reduce(lambda a, b: a + b, [F.col(c) for c in parts]) - F.lit(total))
    return df.where(gap.isNotNull()).groupBy(year).agg(
        F.count(F.lit(1)).alias("n_complete"),
        F.sum((gap > tolerance).cast("long")).alias("n_broken"),
        half_even(F.max(gap), 6).alias("max_gap"),
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError("required columns are missing: " + ", ".join(missing))


def level_ratio(
    df: DataFrame, top: str, bottom: str, year: str = "ano", name: str = "razao"
) -> DataFrame:
    """Ratio of two rates where both exist and the divisor is above zero."""
    return df.where(F.col(top).isNotNull() & (F.col(bottom) > 0)).select(
        year, top, bottom, half_even(F.col(top) / F.col(bottom), 2).alias(name)
    )
