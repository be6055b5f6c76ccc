"""Registered queries with exact SQL, one function per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelrisk import settings
from panelrisk.functions.columns import (
    half_even, level_of, period_of,
)
from panelrisk.functions.text import fixed, percent, points
from panelrisk.operators import cleaning, integrate, ordering, quality, ranking, series, stats
from panelrisk.plans import inputs
from panelrisk.plans.inputs import (
    FACT_COLUMNS, UNIT_KEYS, context_yearly, fact_integrated, formula_scored, joined_rows,
    risk_scored, with_period, year_integrated,
)
from panelrisk.sources import panel as recipe
from panelrisk.sources import tables
from panelrisk.sources.panel import INDICATORS, RATES, TARGET, context, panel
from panelrisk.storage import materialize, new_path

CORR_PAIRS = [("aprov_em", "aband_em"), ("tdi_em", "aband_em"),
              ("reprov_em", "aband_em"), ("aband_ef", "aband_em")]
LINE_PAIRS = [("tdi_em", "aband_em"), ("tdi_em", "aband_ef"), ("reprov_em", "aband_em")]


def doubled(spark: SparkSession, folder: str) -> DataFrame:
    """Panel with every fifth unit twice, so that repeated rows exist."""
    copies = F.when(F.col("ent") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return panel(spark, folder).withColumn("_copy", F.explode(copies)).drop("_copy")


# -- sources and sinks

def scan_typed(spark, folder):
    path = new_path(spark, "csv")
    tables.write_csv(panel(spark, folder), path)
    return tables.read_csv(spark, path, panel(spark, folder).schema)


def sink_roundtrip(spark, folder):
    path = new_path(spark, "sink")
    rows = panel(spark, folder)
    tables.write_table(rows, path, ["ano"])
    return tables.read_or_none(spark, path).select(*rows.columns)


# -- cleaning, levels, filters

def dedup_rows(spark, folder):
    return cleaning.dedup_rows(doubled(spark, folder))


def duplicate_counts(spark, folder):
    return cleaning.duplicate_counts(doubled(spark, folder))


def clean_rates(spark, folder):
    wide = doubled(spark, folder).select(
        "ent", "ano", *[(F.col(c) * 4 - 60).alias(c) for c in RATES], "atu_em"
    )
    return cleaning.clean_rates(wide, "ano", ["ent"], ("aband_", "reprov_", "aprov_", "tdi_"))


def coerce_numeric(spark, folder):
    raw = F.regexp_extract("props", '"k": *([^,}]*)', 1)
    rows = tables.parquet_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.concat(raw, F.lit(" x")))
        .when(F.col("event_id") % 7 == 0, F.lit(""))
        .otherwise(raw).alias("k"),
    )
    return cleaning.coerce_numeric(rows, [])


def period_label(spark, folder):
    return with_period(panel(spark, folder).select(*UNIT_KEYS))


def period_label_alt(spark, folder):
    label = period_of("ano", recipe.PERIODS_ALT, recipe.PERIODS_ALT_LAST)
    return panel(spark, folder).select(*UNIT_KEYS, label.alias("periodo"))


def risk_level(spark, folder):
    return inputs.with_levels(panel(spark, folder)).select(
        *UNIT_KEYS, "aband_ef", "aband_em", "risco_ef", "risco_em"
    )


def score_level(spark, folder):
    level = level_of("score", settings.SCORE_CUTS, settings.SCORE_LABELS)
    return risk_scored(spark, folder).select(*UNIT_KEYS, "score", level.alias("nivel"))


def pred_level(spark, folder):
    level = level_of(
        "pred", settings.PREDICTION_CUTS, settings.PREDICTION_LABELS, closed="left"
    )
    return formula_scored(spark, folder).select(*UNIT_KEYS, "pred", level.alias("faixa"))


def diagnose_thresholds(spark, folder):
    return series.diagnose_thresholds(
        year_integrated(spark, folder), recipe.DIAGNOSIS_LIMITS, settings.DIAGNOSIS_LEVELS
    )


def dense_row_id(spark, folder):
    return ordering.number_rows(panel(spark, folder).select(*UNIT_KEYS), ["ano", "ent"], "id_linha")


def risk_index(spark, folder):
    return joined_rows(spark, folder).select(*UNIT_KEYS, "indice_risco")


def risk_score(spark, folder):
    return risk_scored(spark, folder).select(*UNIT_KEYS, "score")


def level_ratio(spark, folder):
    ratio = cleaning.level_ratio(year_integrated(spark, folder), "evasao_em", "evasao_ef")
    peak = F.max(F.struct("razao", (-F.col("ano")).alias("y")))
    return ratio.agg(
        F.count(F.lit(1)).alias("n"), half_even(F.avg("razao"), 1).alias("media"),
        peak.alias("p"),
    ).select("n", "media", half_even("p.razao", 1).alias("maximo"),
             (-F.col("p.y")).alias("ano_max"))


def year_filter(spark, folder):
    return cleaning.year_filter(panel(spark, folder, 1997, 1999), 1997, 1999)


def last_n_years(spark, folder):
    years = recipe.panel_years(spark, folder).orderBy(F.desc("ano")).limit(4).collect()
    return panel(spark, folder, min(r["ano"] for r in years)) if years else panel(spark, folder)


def at_risk(spark, folder):
    return cleaning.at_risk(panel(spark, folder), recipe.AT_RISK_LIMITS, UNIT_KEYS)


def drop_nulls(spark, folder):
    return cleaning.drop_nulls(panel(spark, folder), [TARGET], ["tdi_em", "had_em"])


def identity_check(spark, folder):
    return cleaning.identity_check(
        panel(spark, folder), ["aprov_em", "reprov_em", "aband_ef"], tolerance=3.0
    )


# -- joins

def lookup_first(spark, folder):
    detail = panel(spark, folder)
    return integrate.lookup_first(
        context_yearly(spark, folder).select("ano", "evasao_em"), detail, "had_em", ["ent"]
    )


def distinct_on_year(spark, folder):
    rows = panel(spark, folder)
    return integrate.distinct_on(
        rows, ["ano"], {"ent": F.min("ent"), "aband_ef": F.min_by("aband_ef", "ent")}
    )


def unique_ids(spark, folder):
    return integrate.check_unique(fact_integrated(spark, folder), "id_linha")


# -- aggregates

def yearly_means(spark, folder):
    return integrate.yearly_means(panel(spark, folder), INDICATORS)


def _report_tables(spark, folder):
    """Each stage is written once; the report then reads narrow tables."""
    raw = materialize(doubled(spark, folder), "raw")
    units = inputs.with_levels(with_period(cleaning.dedup_rows(raw)))
    base = context(spark, folder)
    yearly = with_period(integrate.yearly_means(base, recipe.CONTEXT_RATES))
    fact = integrate.integrate_fact(units, yearly, recipe.INDEX_WEIGHTS, distinct=True)
    return {"panel_bruta": raw, "context_bruta": base, "panel_processada": units,
            "fato_processada": fact}


def missing_by_column(spark, folder):
    return quality.missing_by_column(_report_tables(spark, folder))


def missing_global(spark, folder):
    return quality.missing_global(quality.missing_by_column(_report_tables(spark, folder)))


def table_shapes(spark, folder):
    t = _report_tables(spark, folder)
    return quality.table_shapes([
        ("panel", "bruta", t["panel_bruta"]),
        ("panel", "processada", t["panel_processada"]),
        ("context", "bruta", t["context_bruta"]),
        ("integracao", "processada", t["fato_processada"]),
    ])


def describe_long(spark, folder):
    return stats.describe_long(panel(spark, folder), INDICATORS)


def exec_summary(spark, folder):
    return stats.exec_summary(joined_rows(spark, folder),
                              ["evasao_ef", "evasao_em", "aband_ef", "aband_em", "tdi_em", "atu_em"])


def corr_matrix(spark, folder):
    return stats.corr_matrix(joined_rows(spark, folder), FACT_COLUMNS)


def corr_target(spark, folder):
    return stats.corr_target(joined_rows(spark, folder), TARGET, FACT_COLUMNS)


def corr_strength(spark, folder):
    return stats.corr_strength(
        joined_rows(spark, folder), CORR_PAIRS, settings.CORR_STRENGTH, settings.CORR_STRENGTH_ELSE
    )


def corr_findings(spark, folder):
    return stats.corr_findings(
        joined_rows(spark, folder), CORR_PAIRS, settings.CORR_REPORT_ABOVE,
        settings.CORR_INVERSE_TEXT, settings.CORR_DIRECT_TEXT,
    )


def trend_line(spark, folder):
    return stats.trend_lines(panel(spark, folder), LINE_PAIRS)


def trend_points(spark, folder):
    fit = stats.line_fit(panel(spark, folder), "tdi_em", "aband_em")
    return stats.line_points(fit).select(
        "step", half_even("x", 4).alias("x"), half_even("y", 4).alias("y")
    )


def histogram25(spark, folder):
    return stats.histogram(panel(spark, folder), ["aband_em", "aband_ef", "tdi_em"])


def boxplot_period(spark, folder):
    rows = with_period(panel(spark, folder).select(*UNIT_KEYS, TARGET))
    cols = ("q1", "q2", "q3", "whisker_low", "whisker_high")
    return stats.round_columns(stats.box_numbers(rows, "periodo", TARGET), dict.fromkeys(cols, 6))


def outliers_period(spark, folder):
    rows = with_period(panel(spark, folder).select(*UNIT_KEYS, TARGET))
    return stats.box_outliers(rows, "periodo", TARGET).select(*UNIT_KEYS, "periodo", TARGET)


def extreme_years(spark, folder):
    return series.extreme_years(year_integrated(spark, folder), ["evasao_em", "aband_em", "tdi_em"])


def extreme_changes(spark, folder):
    return series.extreme_changes(yoy_change(spark, folder), "evasao_em")


def series_delta(spark, folder):
    return series.series_delta(year_integrated(spark, folder), ["evasao_em", "aband_em", "tdi_em"])


def latest_vs_prev(spark, folder):
    return series.latest_vs_prev(
        year_integrated(spark, folder), "indice_risco", settings.SCORE_CUTS, settings.SCORE_LABELS
    )


def kpi_cards(spark, folder):
    return series.kpi_cards(
        year_integrated(spark, folder),
        ["evasao_ef", "evasao_em", "aband_em", "tdi_em", "indice_risco"],
    )


def improvement_count(spark, folder):
    return series.improvement_count(year_integrated(spark, folder), recipe.LOWER_IS_BETTER)


def shock_means(spark, folder):
    return series.shock_means(year_integrated(spark, folder), "indice_risco", recipe.SHOCK_WINDOW)


def period_compare(spark, folder):
    return series.period_compare(
        year_integrated(spark, folder), ["evasao_em", "aband_em", "tdi_em"],
        recipe.BASELINE_WINDOW, recipe.SHOCK_WINDOW,
    )


def distinct_years(spark, folder):
    return series.distinct_years(panel(spark, folder), ["ent"])


def sparse_columns(spark, folder):
    train = panel(spark, folder, last=recipe.SPLIT_YEAR)
    return quality.sparse_columns(train, INDICATORS, 0.3)


def rows_with_any_null(spark, folder):
    train = panel(spark, folder, last=recipe.SPLIT_YEAR)
    return quality.rows_with_any_null(train, INDICATORS)


def best_per_group(spark, folder):
    gap = F.abs(F.col("pred") - F.col(TARGET))
    rows = formula_scored(spark, folder).select("ano", "ent", gap.alias("erro"))
    return ranking.best_per_group(rows, "ano", "erro", ["ent"]).withColumn(
        "erro", half_even("erro", 6)
    )


def project_trend(spark, folder):
    return series.project_trend(
        risk_scored(spark, folder), "score", settings.SCORE_CUTS, settings.SCORE_LABELS
    )


def regression_metrics(spark, folder):
    table = stats.regression_metrics(formula_scored(spark, folder), TARGET, "pred", ["ano"])
    return stats.round_columns(table, {"mae": 6, "rmse": 6, "r2": 6})


# -- windows, sort, sets

def yoy_change(spark, folder):
    cols = ["evasao_em", "aband_em", "tdi_em", "indice_risco"]
    change = series.yoy_change(year_integrated(spark, folder), cols)
    return series.with_direction(change, ["evasao_em"])


def yoy_change_by_unit(spark, folder):
    return series.yoy_change(panel(spark, folder), ["aband_em", "tdi_em"], partition=["ent"])


def risk_rank_dense(spark, folder):
    rows = formula_scored(spark, folder, first=recipe.SPLIT_YEAR + 1)
    return ordering.dense_rank_rows(rows.select(*UNIT_KEYS, "pred"), "pred", UNIT_KEYS, "posicao")


def top_risk(spark, folder):
    rows = formula_scored(spark, folder, first=recipe.SPLIT_YEAR + 1)
    return ranking.top_rows(rows.select(*UNIT_KEYS, TARGET, "pred"), "pred", 15, UNIT_KEYS)


def top_missing(spark, folder):
    return quality.top_missing(panel(spark, folder), INDICATORS, 5)


def row_top_indicators(spark, folder):
    return ranking.row_top_indicators(panel(spark, folder), UNIT_KEYS, INDICATORS)


def union_splits(spark, folder):
    rows = formula_scored(spark, folder).select(*UNIT_KEYS, TARGET, "pred")
    train = rows.where(F.col("ano") <= recipe.SPLIT_YEAR)
    test = rows.where(F.col("ano") > recipe.SPLIT_YEAR).withColumn(
        "faixa", level_of("pred", settings.PREDICTION_CUTS, settings.PREDICTION_LABELS, "left")
    )
    return integrate.union_splits({"treino": train, "teste": test})


# -- text

def format_pp(spark, folder):
    change = series.yoy_change(panel(spark, folder), [TARGET], partition=["ent"])
    return change.select(
        "ent", "ano", percent(TARGET).alias("texto"), points(f"var_{TARGET}").alias("variacao")
    )


def format_params(spark, folder):
    kind = F.when(F.col("ent") % 3 == 0, "boosting").when(F.col("ent") % 3 == 1, "tree")
    rows = panel(spark, folder).withColumn("algoritmo", kind.otherwise("knn"))
    text = ranking.format_params(F.col("algoritmo"), {
        "boosting": [("lr", fixed("had_em", 2)), ("depth", fixed("tdi_em", 0)),
                     ("leaf", fixed("atu_em", 0))],
        "tree": [("depth", fixed("tdi_em", 0)), ("leaf", fixed("atu_em", 0))],
        "knn": [("k", fixed("atu_em", 0)), ("weights", F.lit("distance"))],
    })
    return rows.select("ent", "ano", "algoritmo", text.alias("parametros"))


def summary_json(spark, folder):
    table = stats.regression_metrics(formula_scored(spark, folder), TARGET, "pred", ["ano"])
    body = F.to_json(F.struct(
        F.col("ano"), F.col("n"), fixed("mae", 4).alias("mae"), fixed("rmse", 4).alias("rmse")
    ))
    return table.select("ano", body.alias("resumo"))


# -- chart inputs

def series_long(spark, folder):
    return series.series_long(year_integrated(spark, folder), FACT_COLUMNS, ["em"])


def paired_series(spark, folder):
    return series.paired_series(year_integrated(spark, folder), "evasao_em", "aband_em")


def summary_by_year(spark, folder):
    return series.summary_by_year(
        year_integrated(spark, folder),
        ["evasao_ef", "evasao_em", "aband_ef", "aband_em", "tdi_em", "atu_em"],
    )


def null_mask(spark, folder):
    return quality.null_mask(panel(spark, folder), ["ano", "ent"])


def action_cards(spark, folder):
    latest = year_integrated(spark, folder).orderBy(F.desc("ano")).limit(1).select(
        F.col("aband_em").alias("taxa_abandono_em"), "tdi_em",
        F.col("repet_em").alias("taxa_repetencia_em"), "atu_em",
    )
    return ranking.action_cards(latest, settings.ACTIONS)


QUERIES = {
    f.__name__: f for f in (
        scan_typed, sink_roundtrip, dedup_rows, duplicate_counts, clean_rates, coerce_numeric,
        period_label, period_label_alt, risk_level, score_level, pred_level, diagnose_thresholds,
        dense_row_id, risk_index, risk_score, level_ratio, year_filter, last_n_years, at_risk,
        drop_nulls, identity_check, year_integrated, fact_integrated, unique_ids, lookup_first,
        yearly_means,
        missing_by_column, missing_global, table_shapes, describe_long, exec_summary, corr_matrix,
        corr_target, corr_strength, corr_findings, trend_line, trend_points, histogram25,
        boxplot_period, outliers_period, extreme_years, extreme_changes, series_delta, latest_vs_prev, kpi_cards,
        improvement_count, shock_means, period_compare, distinct_years, sparse_columns,
        rows_with_any_null, best_per_group, project_trend, regression_metrics, yoy_change,
        yoy_change_by_unit, risk_rank_dense, top_risk, top_missing, row_top_indicators,
        union_splits, distinct_on_year, format_pp, format_params, summary_json, series_long,
        paired_series, summary_by_year, null_mask, action_cards,
    )
}
