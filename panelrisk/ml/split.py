"""Temporal split and year-based folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def temporal_split(df: DataFrame, year_cutoff: int, year: str = "ano") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(year) <= year_cutoff), df.where(F.col(year) > year_cutoff)


def supervised_split(
    df: DataFrame, target: str, year_cutoff: int, year: str = "ano"
) -> tuple[DataFrame, DataFrame]:
    """Split, rows without target dropped; an empty side is an error."""
    if year not in df.columns:
        raise ValueError(f"column {year} is needed for a temporal split")
    train, test = temporal_split(df.where(F.col(target).isNotNull()), year_cutoff, year)
    if train.isEmpty() or test.isEmpty():
        raise ValueError(f"empty split at {year_cutoff}")
    return train, test


def split_summary(df: DataFrame, target: str, year_cutoff: int, year: str = "ano") -> DataFrame:
    """Rows, rows with target and years of each side."""
    side = F.when(F.col(year) <= year_cutoff, F.lit("treino")).otherwise(F.lit("teste"))
    has = F.col(target).isNotNull()
    years = F.array_sort(F.collect_set(F.when(has, F.col(year)))).cast("array<string>")
    return df.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).alias("n_linhas"),
        F.sum(has.cast("long")).alias("n_com_alvo"),
        F.array_join(years, ",").alias("anos"),
    )


def year_folds(df: DataFrame, n_splits: int = 4, year: str = "ano") -> DataFrame:
    """Expanding folds as a table (fold, ano, role); a year is never cut in two.

    With y years and n folds the validation part holds y // (n + 1) years; the
    last fold validates on the last years.
    """
    years = df.where(F.col(year).isNotNull()).select(year).distinct()
    # one row per year
    ranked = years.select(
        year, (F.row_number().over(Window.orderBy(year)) - 1).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("y"),
    ).where(F.assert_true(F.col("y") >= 3, F.lit("at least 3 years are needed")).isNull())
    n = F.least(F.lit(max(2, n_splits)), F.col("y") - 1)
    folds = (
        ranked.withColumn("n", n.cast("int"))
        .withColumn("v", F.floor(F.col("y") / (F.col("n") + 1)))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumn("edge", F.col("y") - (F.col("n") - F.col("fold") + 1) * F.col("v"))
    )
    role = F.when(F.col("pos") < F.col("edge"), F.lit("treino")).when(
        F.col("pos") < F.col("edge") + F.col("v"), F.lit("validacao")
    )
    return folds.withColumn("role", role).where(F.col("role").isNotNull()).select("fold", year, "role")


def fold_years(folds: DataFrame, year: str = "ano") -> list[tuple[int, list[int], list[int]]]:
    """(fold, train years, validation years); bounded by folds times years."""
    rows = folds.groupBy("fold").agg(
        F.collect_list(F.when(F.col("role") == "treino", F.col(year))).alias("t"),
        F.collect_list(F.when(F.col("role") == "validacao", F.col(year))).alias("v"),
    ).orderBy("fold").collect()
    return [(r["fold"], sorted(r["t"]), sorted(r["v"])) for r in rows]


def rows_of(df: DataFrame, years: Sequence[int], year: str = "ano") -> DataFrame:
    return df.where(F.col(year).isin([int(y) for y in years]))
