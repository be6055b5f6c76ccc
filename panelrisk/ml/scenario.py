"""Batch what-if: every unit-year under every scenario, without a join.

A scenario is a name and a shift per input column. The scenarios are a literal
array exploded over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk import settings
from panelrisk.functions.columns import clip, half_even
from panelrisk.functions.text import fixed
from panelrisk.ml.models import score

Inputs = Mapping[str, tuple[str, float, float, float, float, str]]


def scenario_grid(
    df: DataFrame, ids: Sequence[str], inputs: Inputs,
    scenarios: Mapping[str, Mapping[str, float]],
    identity: Sequence[str] = (),
) -> DataFrame:
    """Start and new value of each input per scenario.

    Start is the observed value or the default. Only a shifted input is limited
    to its range. ``fora_da_faixa`` marks rows with a start value outside a range,
    ``soma_alterada`` scenarios that move some of the parts of a fixed sum.
    """
    cols = [c for c in inputs if c in df.columns]
    unknown = {c for shift in scenarios.values() for c in shift} - set(cols)
    if unknown:
        raise ValueError("scenario columns are missing: " + ", ".join(sorted(unknown)))
    table = F.array(*[
        F.struct(
            F.lit(name).alias("cenario"),
            F.lit(bool(set(identity) & set(shift))).alias("soma_alterada"),
            *[F.lit(float(shift.get(c, 0.0))).alias(f"shift_{c}") for c in cols],
        )
        for name, shift in scenarios.items()
    ])
    start = {c: F.coalesce(F.col(c), F.lit(inputs[c][4])) for c in cols}
    outside = F.lit(False)
    for c in cols:
        outside = outside | ~start[c].between(inputs[c][1], inputs[c][2])
    rows = df.select(
        *ids, *[start[c].alias(f"ini_{c}") for c in cols], outside.alias("fora_da_faixa"),
        F.inline(table),
    )
    new = {
        f"novo_{c}": F.when(F.col(f"shift_{c}") == 0, F.col(f"ini_{c}")).otherwise(
            clip(F.col(f"ini_{c}") + F.col(f"shift_{c}"), inputs[c][1], inputs[c][2])
        )
        for c in cols
    }
    return rows.withColumns(new).drop(*[f"shift_{c}" for c in cols])


def _moved(c: str) -> Column:
    return F.abs(F.col(f"novo_{c}") - F.col(f"ini_{c}")) > settings.SCENARIO_TOLERANCE


def scenario_delta(
    grid: DataFrame, predict: Callable[[str], Column], effect: float = settings.SCENARIO_EFFECT
) -> DataFrame:
    """Prediction before and after, difference and effect class.

    ``predict`` gives the prediction from the columns with a prefix.
    """
    before, after = predict("ini_"), predict("novo_")
    scored = grid.withColumns({"pred_original": before, "pred_simulada": after})
    return with_effect(scored, effect)


def with_effect(scored: DataFrame, effect: float = settings.SCENARIO_EFFECT) -> DataFrame:
    gap = F.col("pred_simulada") - F.col("pred_original")
    word = (
        F.when(gap < -effect, F.lit("Reducao de risco"))
        .when(gap > effect, F.lit("Aumento de risco"))
        .otherwise(F.lit("Impacto neutro"))
    )
    return scored.withColumns({"diferenca": gap, "efeito": word})


def score_grid(grid: DataFrame, model, inputs_of_model: Sequence[str], inputs: Inputs) -> DataFrame:
    """Both predictions of a fitted pipeline on the grid, in two chained passes over one frame."""
    cols = _inputs_of(grid, inputs)
    out = grid
    for prefix, name in (("ini_", "pred_original"), ("novo_", "pred_simulada")):
        named = out.withColumns({c: F.col(f"{prefix}{c}") for c in cols})
        out = score(model, named, inputs_of_model, name)
    return with_effect(out)


def _changes(inputs: Inputs, cols: Sequence[str]) -> Column:
    every = F.array(*[
        F.struct(
            F.lit(inputs[c][0]).alias("indicador"), F.lit(inputs[c][5]).alias("unidade"),
            F.col(f"ini_{c}").alias("antes"), F.col(f"novo_{c}").alias("depois"),
            _moved(c).alias("mudou"),
        )
        for c in cols
    ])
    return F.filter(every, lambda x: x["mudou"])


def _inputs_of(grid: DataFrame, inputs: Inputs) -> list[str]:
    return [c for c in inputs if f"ini_{c}" in grid.columns]


def scenario_changes(grid: DataFrame, ids: Sequence[str], inputs: Inputs) -> DataFrame:
    """One row per changed input: old, new and difference, two decimals."""
    rows = grid.select(*ids, "cenario", F.inline(_changes(inputs, _inputs_of(grid, inputs))))
    return rows.select(
        *ids, "cenario", "indicador",
        half_even("antes", 2).alias("valor_original"), half_even("depois", 2).alias("valor_simulado"),
        half_even(F.col("depois") - F.col("antes"), 2).alias("variacao"),
    )


def _with_unit(v: Column, unit: Column) -> Column:
    tail = F.when(unit == "%", F.lit("%")).when(unit == "h", F.lit(" h")).otherwise(F.lit(""))
    return F.concat(fixed(v), tail)


def scenario_text(
    scored: DataFrame, ids: Sequence[str], inputs: Inputs,
    effect: float = settings.SCENARIO_TEXT_EFFECT, high: float = settings.SCENARIO_HIGH_RISK,
) -> DataFrame:
    """Reading of each scenario in words."""
    say = settings.SCENARIO_TEXT
    changes = _changes(inputs, _inputs_of(scored, inputs))

    def phrase(x: Column) -> Column:
        args = (x["indicador"], _with_unit(x["antes"], x["unidade"]),
                _with_unit(x["depois"], x["unidade"]))
        return F.when(x["depois"] < x["antes"], F.format_string(say["down"], *args)).otherwise(
            F.format_string(say["up"], *args)
        )

    cols = _inputs_of(scored, inputs)
    touched = F.exists(
        F.array(*[~F.col(f"novo_{c}").eqNullSafe(F.col(f"ini_{c}")) for c in cols]), lambda x: x
    )
    rows = scored.withColumns({"_f": F.transform(changes, phrase), "_touched": touched})
    count = F.size("_f")
    first = F.get("_f", F.lit(0))
    lead = F.concat(F.upper(F.substring(first, 1, 1)), F.substr(first, F.lit(2)))
    rest = F.array_join(F.slice("_f", 2, F.greatest(count - 1, F.lit(0))), ", ")
    body = F.when(count == 1, lead).otherwise(F.concat(lead, F.lit(say["joined"]), rest))

    p0, p1 = F.col("pred_original"), F.col("pred_simulada")
    gap = p1 - p0
    moved = (
        F.when(gap <= -effect,
               F.format_string(say["less"], fixed(F.abs(gap)), fixed(p0), fixed(p1)))
        .when(gap >= effect, F.format_string(say["more"], fixed(gap), fixed(p0), fixed(p1)))
        .otherwise(F.format_string(say["flat"], fixed(p0), fixed(p1)))
    )
    after = (
        F.when((p1 >= high) & (gap < -effect), F.lit(say["still_high"]))
        .when((p1 >= high) & (gap >= 0), F.lit(say["high"]))
        .when(gap <= -effect, F.lit(say["gain"]))
        .otherwise(F.lit(""))
    )
    text = (
        F.when(~F.col("_touched"), F.format_string(say["none"], fixed(p0)))
        .when(count == 0, F.format_string(say["tiny"], fixed(p0), fixed(p1)))
        .otherwise(F.concat(body, moved, after, F.lit(say["note"])))
    )
    return rows.select(*ids, "cenario", text.alias("texto"))
