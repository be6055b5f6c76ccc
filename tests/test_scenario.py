import pytest
from pyspark.sql import functions as F

from panelrisk.ml.scenario import scenario_changes, scenario_delta, scenario_grid, scenario_text

INPUTS = {"t": ("TDI", 0.0, 100.0, 0.5, 25.0, "%"), "h": ("Horas", 3.0, 10.0, 0.1, 5.5, "h")}


def grid(spark, rows, scenarios):
    df = spark.createDataFrame(rows, "id int, t double, h double")
    return scenario_grid(df, ["id"], INPUTS, scenarios, ("t",))


def predict(prefix):
    return F.col(f"{prefix}t") * 0.5


def test_defaults_and_ranges(spark):
    out = grid(spark, [(1, None, 2.0)], {"s": {"t": 80.0}, "n": {}}).collect()
    got = {r["cenario"]: r for r in out}
    assert (got["s"]["ini_t"], got["s"]["novo_t"], got["s"]["novo_h"]) == (25.0, 100.0, 2.0)
    assert got["s"]["fora_da_faixa"] and got["s"]["soma_alterada"]
    assert not got["n"]["soma_alterada"] and got["n"]["novo_t"] == 25.0


def test_unknown_column(spark):
    with pytest.raises(ValueError, match="zz"):
        grid(spark, [(1, 1.0, 4.0)], {"s": {"zz": 1.0}})


def text(spark, t, shift):
    scored = scenario_delta(grid(spark, [(1, t, 5.0)], {"s": shift}), predict)
    return scenario_text(scored, ["id"], INPUTS).first()["texto"]


def test_texts(spark):
    assert text(spark, 10.0, {}).startswith("Nenhum indicador")
    assert text(spark, 10.0, {"t": 1e-7}).startswith("Os indicadores foram ajustados")
    down = text(spark, 10.0, {"t": -4.0})
    assert down.startswith("A redução de **TDI** de 10.0% para 6.0% resultou em uma")
    assert "ganho de risco" in down
    both = text(spark, 40.0, {"t": -4.0, "h": 1.0})
    assert ", combinada com o aumento de **Horas** de 5.0 h para 6.0 h" in both
    assert "permanece **elevado** —" in both
    assert "impacto marginal" in text(spark, 10.0, {"h": 1.0})
    assert "altos níveis" in text(spark, 30.0, {"t": 4.0})


def test_changes_and_effect(spark):
    g = grid(spark, [(1, 10.0, 5.0)], {"s": {"t": -4.0}, "n": {}})
    rows = scenario_changes(g, ["id"], INPUTS).collect()
    assert [(r["cenario"], r["indicador"], r["variacao"]) for r in rows] == [("s", "TDI", -4.0)]
    effect = {r["cenario"]: r["efeito"] for r in scenario_delta(g, predict).collect()}
    assert effect == {"s": "Reducao de risco", "n": "Impacto neutro"}
