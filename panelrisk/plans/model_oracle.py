"""SQL for the modelling queries that have an exact answer."""

from __future__ import annotations

from panelrisk import settings
from panelrisk.plans.model_queries import (
    NEAR_PROFILE, PROFILE, SCENARIO_INPUTS, SCENARIOS,
)
from panelrisk.plans.oracle import BASE, P_PRED, TEST, TRAIN, one, rate_level, rnd
from panelrisk.sources.panel import INDICATORS

INPUTS = list(SCENARIO_INPUTS)

FOLDS = f"""
ty as (select distinct ano from preds where {TRAIN}),
yr as (select ano, row_number() over (order by ano) - 1 as pos, count(*) over () as y from ty),
fp as (select *, least(4, y - 1) as n, y // (least(4, y - 1) + 1) as v from yr),
fe as (select ano, pos, v, fold, y - (n - fold + 1) * v as edge
       from fp, range(1, 5) t(fold) where fold <= n),
folds as (
  select fold::int as fold, ano,
    case when pos < edge then 'treino' when pos < edge + v then 'validacao' end as role
  from fe where pos < edge + v),
ferr as (
  select fold, role, count(*) as n, avg(abs(aband_em - pred)) as mae,
    sqrt(avg((aband_em - pred) * (aband_em - pred))) as rmse,
    1 - sum((aband_em - pred) * (aband_em - pred)) / (var_pop(aband_em) * count(*)) as r2
  from preds join folds using (ano) group by 1, 2)"""

P_FOLDS = f"{P_PRED}, {FOLDS}"

METRICS = ("mae", "rmse", "r2")
SUMMARY = "select count(distinct fold) as n_folds, " + ", ".join(
    f"{f}(case when role = 'validacao' then {m} end) as {m}_validacao_{s}"
    for m in METRICS for f, s in (("avg", "media"), ("stddev_pop", "dp"))
) + ", " + ", ".join(
    f"avg(case when role = 'treino' then {m} end) as {m}_treino_media" for m in ("mae", "r2")
) + " from ferr"
SUMMARY_COLS = [f"{m}_validacao_{s}" for m in METRICS for s in ("media", "dp")] + [
    f"{m}_treino_media" for m in ("mae", "r2")]


def _vectors() -> str:
    mid = ", ".join(f"median({c}) as md_{c}" for c in PROFILE)
    filled = ", ".join(f"coalesce({c}, md_{c}) as f_{c}" for c in PROFILE)
    moments = ", ".join(f"avg(f_{c}) as mu_{c}, stddev_pop(f_{c}) as sd_{c}" for c in PROFILE)
    z = ", ".join(f"(coalesce({c}, md_{c}) - mu_{c}) / sd_{c} as z_{c}" for c in PROFILE)
    gap = " + ".join(f"(q.z_{c} - t.z_{c}) * (q.z_{c} - t.z_{c})" for c in PROFILE)
    carry = ", ".join(f"t.{c} as viz_{c}" for c in NEAR_PROFILE)
    return f"""{BASE},
    known as (select * from panel where aband_em is not null),
    md as (select {mid} from known where {TRAIN}),
    sc as (select {moments} from (select {filled} from known, md where {TRAIN})),
    z as (select known.*, {z} from known, md, sc),
    pairs as (
      select q.ent, q.ano, sqrt({gap}) as dist, t.ent as viz_ent, t.ano as viz_ano, {carry}
      from (select * from z where {TEST}) q, (select * from z where {TRAIN}) t),
    near as (
      select * from (select *, row_number() over (partition by ent, ano
        order by dist, viz_ent, viz_ano)::int as ordem from pairs) where ordem <= 5)"""


def _grid() -> str:
    values = ", ".join(
        f"('{name}', {str(bool({'aprov_em', 'reprov_em'} & set(shift))).lower()}, "
        + ", ".join(f"{shift.get(c, 0.0)}::double" for c in INPUTS) + ")"
        for name, shift in SCENARIOS.items()
    )
    start = ", ".join(
        f"coalesce({c}, {SCENARIO_INPUTS[c][4]}::double) as ini_{c}" for c in INPUTS)
    outside = " or ".join(
        f"ini_{c} not between {SCENARIO_INPUTS[c][1]} and {SCENARIO_INPUTS[c][2]}" for c in INPUTS)
    new = ", ".join(
        f"case when shift_{c} = 0 then ini_{c} else least(greatest(ini_{c} + shift_{c},"
        f" {SCENARIO_INPUTS[c][1]}::double), {SCENARIO_INPUTS[c][2]}::double) end as novo_{c}"
        for c in INPUTS)

    def formula(p: str) -> str:
        return (f"1::double + 0.25::double * {p}tdi_em + 0.5::double * {p}aband_ef"
                f" + 0.05::double * {p}atu_em")

    return f"""{BASE},
    sc(cenario, soma_alterada, {', '.join(f'shift_{c}' for c in INPUTS)}) as (values {values}),
    st as (select ent, ano, {start} from panel),
    grid as (
      select ent, ano, {', '.join(f'ini_{c}' for c in INPUTS)}, ({outside}) as fora_da_faixa,
             cenario, soma_alterada, {new}
      from st, sc),
    scored as (select *, {formula('ini_')} as pred_original, {formula('novo_')} as pred_simulada
               from grid)"""


def _literal(text: str) -> str:
    return text.replace("'", "''").replace("%%", "%")


def _filled(text: str, *args: str) -> str:
    parts = text.split("%s")
    out = [f"'{_literal(parts[0])}'"]
    for arg, tail in zip(args, parts[1:]):
        out += [arg, f"'{_literal(tail)}'"]
    return " || ".join(out)


def _text() -> str:
    say = settings.SCENARIO_TEXT
    phrases = []
    for i, c in enumerate(INPUTS):
        label, unit = SCENARIO_INPUTS[c][0], SCENARIO_INPUTS[c][5]
        tail = {"%": "%", "h": " h"}.get(unit, "")
        args = (f"'{label}'", f"{one(f'ini_{c}')} || '{tail}'", f"{one(f'novo_{c}')} || '{tail}'")
        phrases.append(
            f"select ent, ano, cenario, {i} as i, case when novo_{c} < ini_{c}"
            f" then {_filled(say['down'], *args)} else {_filled(say['up'], *args)} end as f"
            f" from scored where abs(novo_{c} - ini_{c}) > 1e-6")
    p0, p1, gap = "pred_original", "pred_simulada", "(pred_simulada - pred_original)"
    return f"""{_grid()},
    ph as ({' union all '.join(phrases)}),
    nn as (select *, row_number() over (partition by ent, ano, cenario order by i) as rn from ph),
    ff as (select ent, ano, cenario, max(case when rn = 1 then f end) as f1,
             string_agg(f, ', ' order by rn) filter (where rn > 1) as rest
           from nn group by 1, 2, 3)
    select ent, ano, cenario, case when f1 is null then {_filled(say['none'], one(p0))} else
      upper(f1[1]) || f1[2:] || coalesce('{say['joined']}' || rest, '') ||
      case when {gap} <= -0.05 then {_filled(say['less'], one(f'abs({gap})'), one(p0), one(p1))}
           when {gap} >= 0.05 then {_filled(say['more'], one(gap), one(p0), one(p1))}
           else {_filled(say['flat'], one(p0), one(p1))} end ||
      case when {p1} >= 12 and {gap} < -0.05 then '{_literal(say['still_high'])}'
           when {p1} >= 12 and {gap} >= 0 then '{_literal(say['high'])}'
           when {gap} <= -0.05 then '{_literal(say['gain'])}' else '' end
      || '{_literal(say['note'])}' end as texto
    from scored left join ff using (ent, ano, cenario)"""


def _changes() -> str:
    return f"{_grid()} " + " union all ".join(
        f"select ent, ano, cenario, '{SCENARIO_INPUTS[c][0]}' as indicador,"
        f" {rnd(f'ini_{c}', 2)} as valor_original, {rnd(f'novo_{c}', 2)} as valor_simulado,"
        f" {rnd(f'novo_{c} - ini_{c}', 2)} as variacao from grid"
        f" where abs(novo_{c} - ini_{c}) > 1e-6" for c in INPUTS
    )


LEVEL = f"case when aband_em is not null then {rate_level('aband_em')} end"

RES = f"""
res as (select case when ent % 2 = 0 then 'par' else 'impar' end as modelo, aband_em, pred,
  pred - aband_em as residual from preds where aband_em is not null),
resq as (select modelo, quantile_cont(residual, 0.25) as q1, median(residual) as q2,
  quantile_cont(residual, 0.75) as q3 from res group by 1),
resb as (select res.*, q1, q2, q3, residual between q1 - 1.5::double * (q3 - q1)
  and q3 + 1.5::double * (q3 - q1) as inside from res join resq using (modelo))"""

MODEL_ORACLE: dict[str, str] = {
    "model_roundtrip": f"{P_PRED} select ent, ano, true as igual from preds"
    f" where {TEST} and ano in (select year(o_orderdate) from orders where year(o_orderdate) >= 1996)",
    # what the rules of the fitted tree must give on every row with a target
    "tree_paths_hold": f"{P_PRED} select ent, ano, true as mesma_folha, true as mesma_previsao from preds"
    " where ano in (select year(o_orderdate) from orders where year(o_orderdate) >= 1996)",
    "residual_box_formula": f"{P_PRED}, {RES} select modelo, count(*) as n, "
    + ", ".join(f"{rnd(f'any_value({q})', 6)} as {q}" for q in ("q1", "q2", "q3"))
    + f", {rnd('min(case when inside then residual end)', 6)} as whisker_low,"
    f" {rnd('max(case when inside then residual end)', 6)} as whisker_high,"
    " sum(case when inside then 0 else 1 end)::bigint as n_outliers from resb group by 1",
    "compare_text_formula": f"{P_PRED}, {RES}, m as (select modelo, avg(abs(residual)) as mae,"
    " sqrt(avg(residual * residual)) as rmse, 1 - sum(residual * residual)"
    " / (var_pop(aband_em) * count(*)) as r2 from res group by 1) select modelo,"
    " printf('%s: MAE %.2f p.p., RMSE %.2f, R2 %.2f (%s)', modelo, mae, rmse, coalesce(r2, 0),"
    " case when mae = (select min(mae) from m) then 'menor erro medio' else 'comparado' end)"
    " as texto from m",
    "cluster_profiles_given": f"{BASE}, g as (select (ent % 3)::int as cluster, count(*) as n,"
    f" {rnd('avg(aband_em)', 2)} as aband_em, {rnd('avg(tdi_em)', 2)} as tdi_em,"
    f" {rnd('avg(atu_em)', 2)} as atu_em from panel group by 1) select *,"
    " row_number() over (order by aband_em desc nulls last, cluster) = 1 and aband_em is not null as pior,"
    " row_number() over (order by aband_em nulls last, cluster) = 1 and aband_em is not null as melhor from g",
    "impute_median": f"{BASE}, m as (select "
    + ", ".join(f"median({c}) as md_{c}" for c in INDICATORS)
    + f" from panel where {TRAIN}) select ent, ano, "
    + ", ".join(f"{rnd(f'coalesce({c}, md_{c})', 6)} as {c}" for c in INDICATORS)
    + " from panel, m",
    "impute_mode": f"{BASE}, l as (select ent, ano, {LEVEL} as n from panel),"
    f" m as (select n as top from l where {TRAIN} and n is not null group by 1"
    " order by count(*) desc, n limit 1) select ent, ano, coalesce(n, top) as nivel from l, m",
    "standardize": f"{BASE}, m as (select "
    + ", ".join(f"avg({c}) as mu_{c}, stddev_pop({c}) as sd_{c}" for c in INDICATORS)
    + f" from panel where {TRAIN}) select ent, ano, "
    + ", ".join(f"{rnd(f'({c} - mu_{c}) / sd_{c}', 6)} as {c}" for c in INDICATORS)
    + " from panel, m",
    "temporal_split": f"{BASE} select *, case when {TRAIN} then 'treino' else 'teste' end as split"
    " from panel",
    "split_summary": f"{BASE}, s as (select *, case when {TRAIN} then 'treino' else 'teste' end"
    " as split from panel) select split, count(*) as n_linhas, count(aband_em) as n_com_alvo,"
    " string_agg(distinct ano::varchar, ',' order by ano::varchar) filter"
    " (where aband_em is not null) as anos from s group by 1",
    "year_folds": f"{P_FOLDS} select * from folds",
    "cv_errors": f"{P_FOLDS} select fold, role, n, "
    + ", ".join(f"{rnd(m, 6)} as {m}" for m in METRICS) + " from ferr",
    "cv_summary": f"{P_FOLDS}, s as ({SUMMARY}) select n_folds, "
    + ", ".join(f"{rnd(c, 6)} as {c}" for c in SUMMARY_COLS) + " from s",
    "cv_diagnosis": f"{P_FOLDS}, s as ({SUMMARY}), d as (select mae_validacao_media"
    " - mae_treino_media as gap, mae_validacao_dp as sd, r2_validacao_media as r from s)"
    f" select {rnd('gap', 6)} as diferenca_mae, {rnd('sd', 6)} as dp_mae,"
    f" case when gap > 1.5 or sd > 1.5 then '{settings.CV_DIAGNOSIS['unstable']}'"
    f" when gap > 0.6 or sd > 0.8 then '{settings.CV_DIAGNOSIS['overfit']}'"
    f" when r < 0.2 then '{settings.CV_DIAGNOSIS['underfit']}'"
    f" else '{settings.CV_DIAGNOSIS['stable']}' end as diagnostico from d",
    "knn_neighbors": f"{_vectors()} select ent, ano, ordem, {rnd('dist', 6)} as distancia,"
    " viz_ent, viz_ano from near",
    "knn_embeddings": "with v as (select vec_id, embedding::double[] as e from embeddings),"
    " p as (select q.vec_id, t.vec_id as viz_vec_id, list_distance(q.e, t.e) as d"
    " from v q, v t where q.vec_id <> t.vec_id), r as (select *, row_number() over"
    " (partition by vec_id order by d, viz_vec_id)::int as ordem from p)"
    f" select vec_id, ordem, {rnd('d', 6)} as distancia, viz_vec_id from r where ordem <= 5",
    "knn_regress": f"{_vectors()} select ent, ano, {rnd('''case when min(dist) = 0 then
      avg(case when dist = 0 then viz_aband_em end)
      else sum(viz_aband_em / dist) / sum(1 / dist) end''', 6)} as pred from near group by 1, 2",
    "knn_profile": f"{_vectors()}, m as (select ent, ano, "
    + ", ".join(f"{rnd(f'avg(viz_{c})', 6)} as media_{c}" for c in NEAR_PROFILE)
    + " from near group by 1, 2) select m.*, " + ", ".join(f"known.{c}" for c in NEAR_PROFILE)
    + " from m join known using (ent, ano)",
    "scenario_grid": f"{_grid()} select * from grid",
    "scenario_delta": f"{_grid()} select ent, ano, cenario, {rnd('pred_original', 6)}"
    f" as pred_original, {rnd('pred_simulada', 6)} as pred_simulada,"
    f" {rnd('pred_simulada - pred_original', 6)} as diferenca,"
    " case when pred_simulada - pred_original < -0.01 then 'Reducao de risco'"
    " when pred_simulada - pred_original > 0.01 then 'Aumento de risco'"
    " else 'Impacto neutro' end as efeito from scored",
    "scenario_text": _text(),
    "scenario_changes": _changes(),
}
