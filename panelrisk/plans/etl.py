"""From the two raw files to the eight derived tables and the missing-data report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelrisk import settings
from panelrisk.functions.columns import level_of, period_of
from panelrisk.operators import cleaning, integrate, quality, series
from panelrisk.operators.ordering import number_rows
from panelrisk.sources.schemas import FLOW_RAW, SCHOOL_RAW
from panelrisk.sources.tables import read_csv, read_or_none, write_tables
from panelrisk.storage import materialize

IDS = ["id_municipio", "id_municipio_nome"]
INDEX = "indice_risco_evasao"
ROW_ID = "id_linha_educacional"
TREND = ["taxa_evasao_em", "taxa_abandono_em", "tdi_em", INDEX]


def _period(year: str = "ano"):
    return period_of(year, settings.PERIODS, settings.PERIODS_LAST)


def _yearly(df: DataFrame) -> DataFrame:
    skip = {"ano", *IDS, "periodo"}
    values = [c for c, t in df.dtypes if t == "double" and c not in skip]
    return integrate.yearly_means(df, values).withColumn("periodo", _period())


def transform(flow_raw: DataFrame, school_raw: DataFrame) -> dict[str, DataFrame]:
    """The eight derived tables, lazily, on two cleaned tables written once.

    The row id numbers the school rows by year and city and then by all other
    columns, so it does not depend on the order of the file.
    """
    flow = cleaning.clean_rates(flow_raw, "ano", IDS)
    flow = materialize(flow.withColumn("periodo", _period()), "flow")
    school = cleaning.clean_rates(school_raw, "ano", IDS)
    school = school.withColumn("periodo", _period())
    order = ["ano", "id_municipio"]
    order += [c for c in school.columns if c not in order]
    numbered = number_rows(school, order, ROW_ID)
    levels = {
        f"risco_{s}": level_of(f"taxa_abandono_{s}", settings.RATE_CUTS, settings.RATE_LABELS)
        for s in ("ef", "em")
    }
    school = materialize(numbered.withColumns(levels), "school")

    cities = flow.select("ano", "id_municipio")
    socio = integrate.lookup_first(_yearly(flow), cities, "id_municipio", ["id_municipio"])
    socio = materialize(socio, "socio")
    educ = materialize(_yearly(school), "educ")
    both = materialize(
        integrate.integrate_years(
            socio, educ, ["ano", "periodo"], settings.INDEX_WEIGHTS, index=INDEX
        ),
        "both",
    )
    rates = socio.select("ano", *[c for c in socio.columns if c.startswith("taxa_")])
    fact = integrate.integrate_fact(
        school, rates, settings.INDEX_WEIGHTS, index=INDEX, distinct=True
    )
    return {
        "fato_socioeconomico": flow,
        "fato_educacional": school,
        "dim_socio_anual": socio,
        "dim_educ_anual": educ,
        "dim_integrado_anual": both,
        "fato_integrado": fact,
        "escolas_risco": cleaning.at_risk(school, settings.AT_RISK_LIMITS, [ROW_ID]),
        "tendencia_anual": series.yoy_change(both, TREND),
    }


def run_etl(
    spark: SparkSession, flow_csv: str, school_csv: str, folder: str
) -> dict[str, DataFrame]:
    """Read, derive, write and report; returns the written tables."""
    flow = read_csv(spark, flow_csv, FLOW_RAW)
    school = read_csv(spark, school_csv, SCHOOL_RAW)
    tables = transform(flow, school)
    write_tables(tables, folder)
    stored = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in tables}
    facts = ("fato_socioeconomico", "fato_educacional", "fato_integrado")
    report = quality.report(
        {"socioeconomico": flow, "educacional": school}, {k: stored[k] for k in facts}
    )
    write_tables({f"ausentes_{k}": v for k, v in report.items()}, folder)
    return stored


def load_or_build(spark: SparkSession, flow_csv: str, school_csv: str, folder: str):
    """The derived tables, built only where the integrated fact was never written."""
    if read_or_none(spark, f"{folder}/fato_integrado.parquet") is None:
        return run_etl(spark, flow_csv, school_csv, folder)
    names = ("fato_socioeconomico", "fato_educacional", "dim_socio_anual", "dim_educ_anual",
             "dim_integrado_anual", "fato_integrado", "escolas_risco", "tendencia_anual")
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def yearly_table(tables: dict[str, DataFrame]) -> DataFrame | None:
    """The integrated yearly table, or the join of its parts where it is absent."""
    if tables.get("dim_integrado_anual") is not None:
        return tables["dim_integrado_anual"]
    socio, educ = tables.get("dim_socio_anual"), tables.get("dim_educ_anual")
    if socio is None or educ is None:
        return None
    keys = [c for c in ("ano", "periodo") if c in socio.columns and c in educ.columns]
    if not keys:
        return None
    return integrate.integrate_years(socio, educ, keys, settings.INDEX_WEIGHTS, index=INDEX)


