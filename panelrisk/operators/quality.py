"""Missing-data reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from panelrisk.functions.columns import half_even
from panelrisk.storage import materialize


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table (coluna, valores_ausentes, n_linhas) from a single pass."""
    cols = list(columns or df.columns)
    # one short expression per column keeps wide tables cheap to plan
    counts = df.agg(
        F.expr("count(1) as n_linhas"), *[F.expr(f"count_if(`{c}` is null) as `{c}`") for c in cols]
    )
    return counts.unpivot(["n_linhas"], cols, "coluna", "valores_ausentes")


def missing_by_column(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count, percent and rank of each column of each table."""
    parts = [
        null_counts(df)
        .withColumn("tabela", F.lit(name))
        .withColumn("n_colunas", F.lit(len(df.columns)))
        for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    # one row per column of a table
    rank = Window.partitionBy("tabela").orderBy(F.desc("valores_ausentes"))
    return stacked.select(
        "tabela", "n_linhas", "n_colunas", "coluna", "valores_ausentes",
        half_even(_percent("valores_ausentes", "n_linhas"), 2).alias("pct_ausentes"),
        F.rank().over(rank).alias("rank_na_tabela"),
    )


def missing_global(detail: DataFrame) -> DataFrame:
    """Cells, null cells and their percent per table, from the per-column report."""
    sums = detail.groupBy("tabela").agg(
        F.sum("n_linhas").alias("total_celulas"), F.sum("valores_ausentes").alias("total_ausentes")
    )
    return sums.withColumn(
        "pct_ausentes", half_even(_percent("total_ausentes", "total_celulas"), 4)
    )


def _percent(part: str, whole: str):
    share = F.try_divide(F.lit(100.0) * F.col(part).cast("double"), F.col(whole).cast("double"))
    return F.coalesce(share, F.lit(0.0))


def table_shapes(stages: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Rows and columns per (source, stage)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_linhas")).select(
            F.lit(source).alias("fonte"), F.lit(stage).alias("etapa"),
            "n_linhas", F.lit(len(df.columns)).alias("n_colunas"),
        )
        for source, stage, df in stages
    ]
    return reduce(DataFrame.unionByName, parts)


def shapes_of(detail: DataFrame) -> DataFrame:
    """Rows and columns of each reported table, without another scan."""
    return detail.groupBy("tabela").agg(
        F.max("n_linhas").alias("n_linhas"), F.max("n_colunas").alias("n_colunas")
    ).select(
        F.regexp_replace("tabela", "_[^_]*$", "").alias("fonte"),
        F.substring_index("tabela", "_", -1).alias("etapa"), "n_linhas", "n_colunas",
    )


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null share (0..1) per column."""
    return null_counts(df, columns).select(
        "coluna",
        F.coalesce(
            F.try_divide(F.col("valores_ausentes").cast("double"), F.col("n_linhas")), F.lit(0.0)
        ).alias("frac_ausentes"),
    )


def sparse_columns(df: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    """Null share per column and whether it passes the limit."""
    return null_shares(df, columns).withColumn("esparsa", F.col("frac_ausentes") > F.lit(limit))


def rows_with_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.agg(
        F.count(F.lit(1)).alias("n_linhas"),
        F.coalesce(F.sum(any_null.cast("long")), F.lit(0)).alias("n_com_ausente"),
    )


def top_missing(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` columns with the largest null share."""
    return null_shares(df, columns).orderBy(F.desc("frac_ausentes"), "coluna").limit(n)


def null_mask(df: DataFrame, order: Sequence[str], rows: int = 30, columns: int = 40) -> DataFrame:
    """0/1 null flags of the first rows and columns, for a picture."""
    shown = df.columns[:columns]
    first = df.orderBy(*order).limit(rows)
    ids = [c for c in order if c in df.columns]
    return first.select(
        *ids, *[F.col(c).isNull().cast("int").alias(f"falta_{c}") for c in shown if c not in ids]
    )


def report(
    raw: Mapping[str, DataFrame], processed: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The three report tables; raw and processed are told apart by suffix."""
    tables = {f"{k}_bruta": v for k, v in raw.items()}
    tables |= {f"{k}_processada": v for k, v in processed.items()}
    detail = materialize(missing_by_column(tables), "missing")
    return {
        "detalhe": detail,
        "resumo_global": missing_global(detail),
        "formas": shapes_of(detail),
    }
