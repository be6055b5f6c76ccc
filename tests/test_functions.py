from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from panelrisk import settings
from panelrisk.functions.columns import (
    change_direction, clip, finite, half_even, level_of, period_of, threshold_level, to_number,
    weighted_index,
)
from panelrisk.functions.text import fixed, key_values, percent, points


def values(spark, rows, expr, ddl="x double"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)
    return [r[0] for r in df.select(expr).collect()]


WEIGHTS = {"a": 0.4, "b": 0.3, "c": 0.3}


def test_index_renormalises(spark):
    rows = [(10.0, 20.0, 30.0), (None, 20.0, 30.0), (None, 20.0, None), (None, None, None)]
    got = values(spark, rows, weighted_index(WEIGHTS, "abc", 2), "a double, b double, c double")
    assert got == [19.0, 25.0, 20.0, None]


def test_index_ignores_absent_columns(spark):
    rows = [(20.0, 30.0)]
    assert values(spark, rows, weighted_index(WEIGHTS, "bc", 2), "b double, c double") == [25.0]
    assert values(spark, rows, weighted_index(WEIGHTS, "", 2), "b double, c double") == [None]


rate = st.one_of(st.none(), st.floats(0, 100))


@hyp(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(rate, rate, rate), min_size=1, max_size=30))
def test_index_lies_between_components(spark, rows):
    got = values(spark, rows, weighted_index(WEIGHTS, "abc", 2), "a double, b double, c double")
    for row, v in zip(rows, got):
        present = [x for x in row if x is not None]
        if not present:
            assert v is None
        else:
            assert min(present) - 0.0051 <= v <= max(present) + 0.0051


def test_clip_keeps_null(spark):
    assert values(spark, [-3.0, 120.0, None], clip("x", 0.0, 100.0)) == [0.0, 100.0, None]


def test_finite(spark):
    got = values(spark, [float("nan"), float("inf"), 1.0, None], finite("x"))
    assert got == [None, None, 1.0, None]


def test_right_closed_levels(spark):
    got = values(spark, [5.0, 5.01, 10.0, 20.0, 20.01, None],
                 level_of("x", settings.RATE_CUTS, settings.RATE_LABELS))
    assert got == ["Baixo", "Moderado", "Moderado", "Alto", "Crítico", "Sem dado"]


def test_left_closed_levels(spark):
    got = values(spark, [4.99, 5.0, 10.0, 15.0],
                 level_of("x", settings.PREDICTION_CUTS, settings.PREDICTION_LABELS, "left"))
    assert got == ["Baixo", "Moderado", "Alto", "Crítico"]


def test_score_levels(spark):
    got = values(spark, [20.0, 35.0, 50.0, 50.1],
                 level_of("x", settings.SCORE_CUTS, settings.SCORE_LABELS))
    assert got == ["Baixo", "Moderado", "Alto", "Critico"]


def test_periods(spark):
    label = period_of("x", settings.PERIODS, settings.PERIODS_LAST)
    got = values(spark, [2006, 2010, 2011, 2019, 2020, 2022, 2024], label, "x int")
    assert got == ["2006–2010", "2006–2010", "2011–2015", "2016–2019",
                   "2020–2022 (Pandemia)", "2020–2022 (Pandemia)", "2023–2024"]


def test_coerce(spark):
    assert values(spark, ["a", " 1.5", "", "NaN", None], to_number("x"), "x string") == [
        None, 1.5, None, None, None]


def test_half_even(spark):
    assert values(spark, [0.125, 0.375, 2.5, -0.125], half_even("x", 2)) == [0.12, 0.38, 2.5, -0.12]


def test_thresholds_and_direction(spark):
    got = values(spark, [4.9, 5.0, 10.0, None],
                 threshold_level("x", 5.0, 10.0, settings.DIAGNOSIS_LEVELS))
    assert got == ["OK", "Atencao", "Critico", None]
    assert values(spark, [1.0, 0.0, -1.0, None], change_direction("x")) == [
        "worse", "better", "better", None]


def test_texts(spark):
    assert values(spark, [1.25, None], percent("x")) == ["1.2%", None]
    assert values(spark, [1.26, -0.04, -2.0, None], points("x")) == [
        "+1.3 p.p.", "+0.0 p.p.", "-2.0 p.p.", None]
    pairs = key_values([("lr", fixed("x", 2)), ("k", F.lit("5"))])
    assert values(spark, [0.5, None], pairs) == ["lr=0.50, k=5", "k=5"]
