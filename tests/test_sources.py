"""Reading, literals and pushed-down cuts."""

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from panelrisk.functions.columns import half_even
from panelrisk.ml.prep import Preparation, fit_features
from panelrisk.operators import stats
from panelrisk.plans import queries
from panelrisk.settings import MISSING_LABEL
from panelrisk.sources import tables
from panelrisk.storage import delete, materialize_at, new_path, run_dir, stored_bytes

SCHEMA = StructType([StructField("ano", IntegerType()), StructField("x", DoubleType()), StructField("y", DoubleType())])


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ano,x,y\n2000,1,2\n")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path), SCHEMA).collect()] == [(2000, 1.0, 2.0)]
    (tmp_path / "b.csv").write_text("ano,y,x\n2001,20,10\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path), SCHEMA).collect()


def test_nan_is_null_on_read(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (3.0,), (float("inf"),)], "a double").write.parquet(f"{tmp_path}/t.parquet")
    row = stats.describe_long(tables.parquet_table(spark, str(tmp_path), "t"), ["a"]).first()
    assert (row["n"], row["mean"]) == (1, 3.0)


@pytest.mark.parametrize("value", ["a\\", "it's", 'say "x"', "\\u0041", "é😀", "a`b", ""])
def test_any_category_and_column_name(spark, value):
    rows = spark.createDataFrame([(1.0, value), (2.0, None)], "`a b` double, `c-d` string")
    p = Preparation({"a b": 1.5}, {"a b": (0.0, 1.0)}, {"c-d": value})
    out = fit_features(rows, p).transform(rows).collect()
    assert [r["s_c-d"] for r in out] == [value or MISSING_LABEL] * 2


def test_correlations_do_not_depend_on_the_number_of_pairs(spark):
    nan = float("nan")
    data = [(float(i), nan if i == 3 else i * i * 1.0, None if i % 4 == 0 else 7.0 - i, 5.0, (i * 37 % 11) * 1.0)
            for i in range(12)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    pairs = [(x, y) for x in "abcde" for y in "abcde" if x < y]
    every = {(r["a"], r["b"]): (r["r"], r["n"]) for r in stats.corr_pairs(df, pairs, 12).collect()}
    for some in (1, 5, 6):
        part = stats.corr_pairs(df, pairs[:some], 12).collect()
        assert [every[(r["a"], r["b"])] for r in part] == [(r["r"], r["n"]) for r in part]
    assert every[("a", "b")][1] == 11 and every[("a", "d")][0] is None


@pytest.mark.parametrize("key", ["year_filter", "last_n_years", "sparse_columns", "rows_with_any_null", "risk_rank_dense", "top_risk"])
def test_year_cuts_reach_the_scan(spark, small, key):
    from panelrisk.sources import panel as recipe

    if key in ("risk_rank_dense", "top_risk"):
        from panelrisk.plans.inputs import formula_scored

        df = formula_scored(spark, small, first=recipe.SPLIT_YEAR + 1)
    else:
        df = queries.QUERIES[key](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan or "LessThan(l_shipdate" in plan


def test_partitioned_writes_make_few_files(spark, tmp_path):
    rows = spark.range(0, 5000, numPartitions=16).selectExpr("id", "cast(2000 + id % 3 as int) as ano")
    tables.write_table(rows, str(tmp_path / "t"), ["ano"])
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len(files) <= 3 * tables.FILES_PER_VALUE
    found = spark.read.parquet(str(tmp_path / "t")).where("ano = 2001")
    assert found.count() == 1667 and "PartitionFilters: [isnotnull(ano" in found._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_are_measured_and_removed(spark):
    path = new_path(spark, "gone")
    assert path.startswith(run_dir(spark))
    materialize_at(spark.range(3).select(half_even("id", 1).alias("v")), path)
    assert stored_bytes(spark, path) > 0
    delete(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
