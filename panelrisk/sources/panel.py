"""Unit-year panel and yearly context from order and line tables.

A unit is a supplier. Rates are ``100 * matching lines / lines``: the sums are
whole numbers, so a rate does not depend on the order in which they were added.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelrisk.sources.tables import parquet_table

TARGET = "aband_em"
RATES = ["aband_em", "aband_ef", "reprov_em", "aprov_em", "tdi_em"]
INDICATORS = [*RATES, "atu_em", "had_em"]
CONTEXT_RATES = ["evasao_em", "evasao_ef", "repet_em", "promo_em"]

PERIODS = ((1996, "ate 1996"), (1998, "1997-1998"), (1999, "1999"), (2000, "2000"))
PERIODS_LAST = "apos 2000"
PERIODS_ALT = ((1997, "ate 1997"), (1999, "1998-1999"), (2000, "2000"))
PERIODS_ALT_LAST = "apos 2000"
SHOCK_WINDOW = (1999, 2000)
BASELINE_WINDOW = (1996, 1998)
SPLIT_YEAR = 1999

INDEX_WEIGHTS = {"evasao_em": 0.40, "tdi_em": 0.30, "repet_em": 0.30}
SCORE_WEIGHTS = {"aband_em": 0.40, "tdi_em": 0.30, "reprov_em": 0.30}
AT_RISK_LIMITS = {"aband_em": 10.0, "aband_ef": 5.0}
DIAGNOSIS_LIMITS = {
    "evasao_em": (5.0, 10.0),
    "aband_em": (5.0, 10.0),
    "tdi_em": (20.0, 30.0),
    "repet_em": (8.0, 15.0),
    "evasao_ef": (3.0, 6.0),
}
LOWER_IS_BETTER = {
    "evasao_em": True,
    "aband_em": True,
    "tdi_em": True,
    "repet_em": True,
    "aprov_em": False,
}


def share(condition: Column) -> Column:
    hits = F.sum(F.when(condition, 1).otherwise(0)).cast("double")
    return F.lit(100.0) * hits / F.count(F.lit(1))


def within_years(df: DataFrame, day: str, first: int | None, last: int | None) -> DataFrame:
    """Rows of a closed range of years, as a half-open range of the stored column.

    The comparison is with the raw column, so it reaches the scan.
    """
    if first is not None:
        df = df.where(F.col(day) >= F.lit(datetime(first, 1, 1)).cast(df.schema[day].dataType))
    if last is not None:
        df = df.where(F.col(day) < F.lit(datetime(last + 1, 1, 1)).cast(df.schema[day].dataType))
    return df


def panel_years(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct years of the panel, from one column of the scan."""
    days = parquet_table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("ano"))
    return days.where(F.col("ano").isNotNull()).distinct()


def panel(
    spark: SparkSession, folder: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """One row per supplier and shipping year, with the missing values of real data.

    ``first`` and ``last`` cut the scan to a closed range of years.
    """
    c = F.col
    lines = within_years(parquet_table(spark, folder, "lineitem"), "l_shipdate", first, last).select(
        c("l_suppkey").alias("ent"), F.year("l_shipdate").alias("ano"),
        "l_returnflag", "l_discount", "l_quantity", "l_tax",
    )
    rates = lines.groupBy("ent", "ano").agg(
        share((c("l_returnflag") == "R") & (c("l_discount") >= 0.08)).alias("aband_em"),
        share((c("l_returnflag") == "R") & (c("l_discount") <= 0.01)).alias("aband_ef"),
        share((c("l_returnflag") == "A") & (c("l_discount") >= 0.05)).alias("reprov_em"),
        share(c("l_quantity") >= 40).alias("tdi_em"),
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("atu_em"),
        # whole cents, so the sum is exact
        (F.sum(F.rint(c("l_tax") * 100).cast("long")).cast("double") / F.count(F.lit(1)))
        .alias("had_em"),
    ).withColumn("aprov_em", F.lit(100.0) - c("aband_em") - c("reprov_em"))
    no_flow = (c("ent") + c("ano")) % 4 == 0
    return rates.select(
        "ent", "ano",
        F.when(~no_flow, c("aband_em")).alias("aband_em"),
        "aband_ef",
        F.when(~no_flow, c("reprov_em")).alias("reprov_em"),
        F.when(~no_flow, c("aprov_em")).alias("aprov_em"),
        F.when((c("ent") + c("ano")) % 7 != 0, c("tdi_em")).alias("tdi_em"),
        "atu_em",
        F.when(c("ent") % 3 != 0, c("had_em")).alias("had_em"),
    )


def context(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order year from 1996 on."""
    c = F.col
    orders = within_years(parquet_table(spark, folder, "orders"), "o_orderdate", 1996, None).select(
        F.year("o_orderdate").alias("ano"), "o_orderstatus", "o_orderpriority"
    )
    return (
        orders.groupBy("ano")
        .agg(
            share((c("o_orderstatus") == "O") & (c("o_orderpriority") == "5-LOW"))
            .alias("evasao_em"),
            share((c("o_orderstatus") == "P") & (c("o_orderpriority") == "1-URGENT"))
            .alias("evasao_ef"),
            share(c("o_orderpriority") == "4-NOT SPECIFIED").alias("repet_em"),
        )
        .withColumn("promo_em", F.lit(100.0) - c("evasao_em") - c("repet_em"))
    )
