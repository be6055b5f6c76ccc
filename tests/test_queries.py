"""Every registered query with SQL against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference, sql_rows, type_difference

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark, small):
    df = entry.entry(spark)
    assert df.count() > 0 and "indice_risco" in df.columns


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_as_sql(spark, small, con, key):
    df = entry.queries()[key](spark, small)
    assert difference(df, *sql_rows(con, ORACLE[key])) is None
    assert type_difference(df, con, ORACLE[key]) is None


# run as part of another key or by tests/test_suite.py
ELSEWHERE = {"risk_ranking", "compare_models", "cluster_profiles", *entry.TEXT_QUERIES}


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - set(ORACLE) - ELSEWHERE))
def test_model_queries_give_rows(spark, small, key):
    assert entry.queries()[key](spark, small).count() > 0
