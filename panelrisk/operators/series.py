"""Yearly series: changes, extremes, comparisons, projections.

Windows without a partition appear only on tables with one row per year.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelrisk.functions.columns import (
    change_direction, half_even, level_of, long_form, threshold_level,
)
from panelrisk.operators.stats import line_fit


def percent_change(c: Column | str, previous: Column) -> Column:
    """Change against the previous value in percent; a zero before gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return half_even(F.try_divide(c - previous, previous) * F.lit(100.0), 2)


def yoy_change(
    df: DataFrame, columns: Sequence[str], year: str = "ano", partition: Sequence[str] = ()
) -> DataFrame:
    """Percent change against the previous row, per unit if ``partition`` is given.

    A unit has one row per year, so a partition stays small. ``df`` without a
    partition must be a yearly table.
    """
    w = Window.partitionBy(*partition).orderBy(year)
    out = [F.col(c) for c in (*partition, year)]
    for c in columns:
        out += [F.col(c), percent_change(c, F.lag(c).over(w)).alias(f"var_{c}")]
    return df.select(*out)


def with_direction(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    return changes.withColumns({f"sentido_{c}": change_direction(f"var_{c}") for c in columns})


def extreme_years(df: DataFrame, columns: Sequence[str], year: str = "ano") -> DataFrame:
    """Year and value of the maximum and minimum; the earliest year wins a tie."""
    long = long_form(df, [year], columns).where(F.col("value").isNotNull())
    top = F.max(F.struct(F.col("value"), (-F.col(year)).alias("y")))
    low = F.min(F.struct(F.col("value"), F.col(year).alias("y")))
    return long.groupBy("indicator").agg(top.alias("t"), low.alias("l")).select(
        "indicator",
        (-F.col("t.y")).alias("ano_max"), half_even("t.value", 1).alias("val_max"),
        F.col("l.y").alias("ano_min"), half_even("l.value", 1).alias("val_min"),
    )


def extreme_changes(changes: DataFrame, column: str, year: str = "ano") -> DataFrame:
    """Year and value of the largest and smallest yearly change of a column (``var_`` column)."""
    v = F.col(f"var_{column}")
    top = F.max(F.struct(v.alias("v"), (-F.col(year)).alias("y"))).alias("t")
    low = F.min(F.struct(v.alias("v"), F.col(year).alias("y"))).alias("l")
    return changes.where(v.isNotNull()).agg(top, low).select(
        F.lit(column).alias("indicator"), (-F.col("t.y")).alias("ano_pior"), half_even("t.v", 2).alias("var_pior"),
        F.col("l.y").alias("ano_melhor"), half_even("l.v", 2).alias("var_melhor"),
    )


def ends(df: DataFrame, columns: Sequence[str], year: str = "ano") -> DataFrame:
    """First and last year with a value, per column."""
    long = long_form(df, [year], columns).where(F.col("value").isNotNull())
    return long.groupBy("indicator").agg(
        F.min(year).alias("ano_ini"), F.max(year).alias("ano_fim"),
        F.min_by("value", year).alias("v_ini"), F.max_by("value", year).alias("v_fim"),
    )


def series_delta(df: DataFrame, columns: Sequence[str], year: str = "ano") -> DataFrame:
    """First and last value and the total change, one decimal."""
    first, last = half_even("v_ini", 1), half_even("v_fim", 1)
    return ends(df, columns, year).select(
        "indicator", "ano_ini", "ano_fim", first.alias("val_ini"), last.alias("val_fim"),
        half_even(last - first, 1).alias("delta"),
    )


def latest_vs_prev(
    df: DataFrame, score: str, cuts: Sequence[float], labels: Sequence[str], year: str = "ano"
) -> DataFrame:
    """Latest and previous score of a yearly table, and the level of the latest."""
    w = Window.orderBy(F.desc(year))
    ranked = df.where(F.col(score).isNotNull()).select(
        F.col(year), half_even(score, 1).alias("s"), F.row_number().over(w).alias("rn")
    ).where(F.col("rn") <= 2)
    now = F.max(F.when(F.col("rn") == 1, F.col("s")))
    before = F.max(F.when(F.col("rn") == 2, F.col("s")))
    return ranked.agg(
        F.max(year).alias("ano_score"), now.alias("score_atual"),
        F.coalesce(before, now).alias("score_ant"),
    ).where(F.col("ano_score").isNotNull()).withColumn(
        "nivel_score", level_of("score_atual", cuts, labels)
    )


def kpi_cards(
    df: DataFrame, columns: Sequence[str], limits: tuple[float, float] = (5.0, 10.0),
    year: str = "ano",
) -> DataFrame:
    """Value of the last year, change against the year row before, and a verdict.

    A rate above the upper limit is critical, above the lower one needs attention.
    """
    long = long_form(df, [year], columns)
    w = Window.partitionBy("indicator").orderBy(F.desc(year))
    prev = Window.partitionBy("indicator").orderBy(year)
    rows = long.withColumns({
        "anterior": F.lag("value").over(prev), "rn": F.row_number().over(w),
    }).where(F.col("rn") == 1)
    low, high = limits
    verdict = (
        F.when(F.col("value").isNull(), F.lit(None).cast("string"))
        .when(F.col("value") > high, F.lit("critico"))
        .when(F.col("value") > low, F.lit("atencao"))
        .otherwise(F.lit("positivo"))
    )
    return rows.select(
        "indicator", year, half_even("value", 1).alias("valor"),
        half_even(F.col("value") - F.col("anterior"), 1).alias("delta_pp"),
        verdict.alias("situacao"),
    )


def improvement_count(
    df: DataFrame, lower_is_better: Mapping[str, bool], year: str = "ano"
) -> DataFrame:
    """How many indicators are better in the last row than in the first.

    Only indicators with a value in both rows are compared.
    """
    cols = list(lower_is_better)
    long = long_form(df, [year], cols)
    pair = long.groupBy("indicator").agg(
        F.min_by(F.struct("value"), year).alias("a"), F.max_by(F.struct("value"), year).alias("b")
    )
    lower = F.element_at(F.create_map(*[F.lit(x) for kv in lower_is_better.items() for x in kv]),
                         F.col("indicator"))
    change = F.col("b.value") - F.col("a.value")
    better = F.when(lower, change < 0).otherwise(change > 0)
    counted = pair.agg(
        F.coalesce(F.sum(change.isNotNull().cast("long")), F.lit(0)).alias("total"),
        F.coalesce(F.sum((change.isNotNull() & better).cast("long")), F.lit(0)).alias("melhorias"),
    )
    verdict = (
        F.when(F.col("total") == 0, F.lit(None).cast("string"))
        .when(F.col("melhorias") == F.col("total"), F.lit("todos"))
        .when(F.col("melhorias") >= F.floor(F.col("total") / 2), F.lit("maioria"))
        .otherwise(F.lit("minoria"))
    )
    return counted.withColumn("veredito", verdict)


def shock_means(
    df: DataFrame, score: str, window: tuple[int, int], year: str = "ano"
) -> DataFrame:
    """Mean score before, during and after a window of years, and the difference."""
    first, last = window
    y = F.col(year)
    means = df.agg(
        F.avg(F.when(y < first, F.col(score))).alias("antes"),
        F.avg(F.when(y.between(first, last), F.col(score))).alias("durante"),
        F.avg(F.when(y > last, F.col(score))).alias("depois"),
    )
    return means.select(
        *[half_even(c, 1).alias(c) for c in ("antes", "durante", "depois")],
        half_even(F.col("durante") - F.col("antes"), 1).alias("diferenca"),
    )


def period_compare(
    df: DataFrame, columns: Sequence[str], base: tuple[int, int], shock: tuple[int, int],
    year: str = "ano",
) -> DataFrame:
    """Mean of each indicator in two windows of years, where both exist."""
    y = F.col(year)
    means = long_form(df, [year], columns).groupBy("indicator").agg(
        F.avg(F.when(y.between(*base), F.col("value"))).alias("b"),
        F.avg(F.when(y.between(*shock), F.col("value"))).alias("s"),
        F.max_by(year, F.struct(F.col("value"), -y)).alias("ano_pico"),
    )
    return means.where(F.col("b").isNotNull() & F.col("s").isNotNull()).select(
        "indicator", half_even("b", 1).alias("media_base"), half_even("s", 1).alias("media_choque"),
        half_even(F.col("s") - F.col("b"), 1).alias("diferenca"),
        F.col("ano_pico").between(*shock).alias("pico_no_choque"),
    )


def distinct_years(df: DataFrame, ids: Sequence[str], year: str = "ano") -> DataFrame:
    """Sorted distinct years and distinct counts of id columns."""
    return df.agg(
        F.array_join(F.array_sort(F.collect_set(year)).cast("array<string>"), ",").alias("anos"),
        F.count_distinct(year).alias("n_anos"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in ids],
    )


def diagnose_thresholds(
    df: DataFrame, limits: Mapping[str, tuple[float, float]], levels: Sequence[str],
    year: str = "ano",
) -> DataFrame:
    """Indicators of the latest year, grouped by level; missing ones are skipped."""
    latest = df.orderBy(F.desc(year)).limit(1)
    long = long_form(latest, [year], list(limits)).where(F.col("value").isNotNull())
    pairs = F.create_map(*[
        x for k, (a, b) in limits.items()
        for x in (F.lit(k), F.struct(F.lit(a).alias("a"), F.lit(b).alias("c")))
    ])
    limit = F.element_at(pairs, F.col("indicator"))
    level = threshold_level("value", limit["a"], limit["c"], levels)
    return long.withColumn("nivel", level).groupBy(year, "nivel").agg(
        F.count(F.lit(1)).alias("n"),
        # at most one entry per named indicator
        F.array_join(F.array_sort(F.collect_list("indicator")), ",").alias("indicadores"),
    )


def project_trend(
    df: DataFrame, score: str, cuts: Sequence[float], labels: Sequence[str],
    years_ahead: int = 2, min_years: int = 4, year: str = "ano",
) -> DataFrame:
    """Mean score per year, its line, and the next years floored at zero."""
    yearly = df.groupBy(year).agg(F.avg(score).alias("score")).where(F.col("score").isNotNull())
    fit = line_fit(yearly, year, "score", min_years).where(F.col("slope").isNotNull())
    ahead = fit.withColumn("passo", F.explode(F.sequence(F.lit(1), F.lit(years_ahead))))
    target = F.col("max_x") + F.col("passo")
    value = F.greatest(F.lit(0.0), F.col("slope") * target + F.col("intercept"))
    return ahead.select(
        target.cast("int").alias("ano"), half_even(value, 1).alias("score_estimado")
    ).withColumn("nivel_estimado", level_of("score_estimado", cuts, labels))


def series_long(
    df: DataFrame, columns: Sequence[str], levels: Sequence[str], year: str = "ano"
) -> DataFrame:
    """Long series of the columns whose suffix names a chosen level."""
    chosen = [c for c in columns if c.rsplit("_", 1)[-1] in levels]
    return long_form(df, [year], chosen).where(F.col("value").isNotNull())


def paired_series(df: DataFrame, a: str, b: str, year: str = "ano") -> DataFrame:
    """Two series on the years where both exist."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(year, a, b)


def summary_by_year(df: DataFrame, columns: Sequence[str], year: str = "ano") -> DataFrame:
    return df.select(year, *[half_even(c, 2).alias(c) for c in columns]).orderBy(year)
