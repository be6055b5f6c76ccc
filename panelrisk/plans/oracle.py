"""SQL with the same answers, for checking on the same Parquet tables."""

from __future__ import annotations

from itertools import combinations

from panelrisk import settings
from panelrisk.sources import panel as recipe
from panelrisk.sources.panel import CONTEXT_RATES, INDICATORS, RATES

ALL = [*INDICATORS, *CONTEXT_RATES]


def rnd(expr: str, digits: int) -> str:
    scale = 10**digits
    return f"(round_even(({expr})::double * {scale}::double, 0)::double / {scale}::double)"


def _share(cond: str) -> str:
    return f"100::double * sum(case when {cond} then 1 else 0 end)::double / count(*)::double"


def _periods(year: str, breaks, last: str) -> str:
    arms = " ".join(f"when {year} <= {u} then '{lab}'" for u, lab in breaks)
    return f"case {arms} when {year} is not null then '{last}' end"


def period(year: str = "ano") -> str:
    return _periods(year, recipe.PERIODS, recipe.PERIODS_LAST)


def level(v: str, cuts, labels, op: str = "<=") -> str:
    arms = " ".join(f"when {v} {op} {c} then '{lab}'" for c, lab in zip(cuts, labels))
    return f"case when {v} is null then '{settings.MISSING_LABEL}' {arms} else '{labels[-1]}' end"


def rate_level(v: str) -> str:
    return level(v, settings.RATE_CUTS, settings.RATE_LABELS)


def score_level(v: str) -> str:
    return level(v, settings.SCORE_CUTS, settings.SCORE_LABELS)


def pred_level(v: str) -> str:
    return level(v, settings.PREDICTION_CUTS, settings.PREDICTION_LABELS, "<")


def index(weights, digits: int) -> str:
    num = " + ".join(f"coalesce({c} * {w}::double, 0::double)" for c, w in weights.items())
    den = " + ".join(
        f"(case when {c} is null then 0::double else {w}::double end)" for c, w in weights.items()
    )
    ratio = f"({num}) / nullif({den}, 0)"
    return rnd(f"case when ({den}) > 0 then least(greatest({ratio}, 0), 100) end", digits)


def one(v: str, digits: int = 1) -> str:
    """Fixed-point text of a rounded value."""
    return f"printf('%.{digits}f', {rnd(v, digits)} + 0::double)"


def plus(v: str, digits: int = 1) -> str:
    return f"printf('%+.{digits}f', {rnd(v, digits)} + 0::double)"


PANEL = f"""
lines as (
  select l_suppkey as ent, year(l_shipdate)::int as ano, l_returnflag f, l_discount d,
         l_quantity q, cast(round(l_tax * 100) as bigint) t
  from lineitem),
cells as (
  select ent, ano,
    {_share("f = 'R' and d >= 0.08::double")} as aband_em,
    {_share("f = 'R' and d <= 0.01::double")} as aband_ef,
    {_share("f = 'A' and d >= 0.05::double")} as reprov_em,
    {_share("q >= 40")} as tdi_em,
    sum(q) / count(*)::double as atu_em,
    sum(t)::double / count(*)::double as had_em
  from lines group by ent, ano),
panel as (
  select ent, ano,
    case when (ent + ano) % 4 <> 0 then aband_em end as aband_em,
    aband_ef,
    case when (ent + ano) % 4 <> 0 then reprov_em end as reprov_em,
    case when (ent + ano) % 4 <> 0 then 100::double - aband_em - reprov_em end as aprov_em,
    case when (ent + ano) % 7 <> 0 then tdi_em end as tdi_em,
    atu_em,
    case when ent % 3 <> 0 then had_em end as had_em
  from cells)"""

CONTEXT = f"""
context as (
  select *, 100::double - evasao_em - repet_em as promo_em from (
    select year(o_orderdate)::int as ano,
      {_share("o_orderstatus = 'O' and o_orderpriority = '5-LOW'")} as evasao_em,
      {_share("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")} as evasao_ef,
      {_share("o_orderpriority = '4-NOT SPECIFIED'")} as repet_em
    from orders where year(o_orderdate) >= 1996 group by 1))"""


def _means(source: str, cols) -> str:
    body = ", ".join(f"{rnd(f'avg({c})', 2)} as {c}" for c in cols)
    return f"select ano, {body}, {period()} as periodo from {source} group by ano"


YEARLY = f"""
ctx as ({_means('context', CONTEXT_RATES)}),
pan as ({_means('panel', INDICATORS)}),
yearly as (
  select y.*, {index(recipe.INDEX_WEIGHTS, 2)} as indice_risco
  from (select ano, periodo, {', '.join(CONTEXT_RATES)}, {', '.join(INDICATORS)}
        from ctx join pan using (ano, periodo)) y)"""

FACT = f"""
units as (
  select *, {period()} as periodo, {rate_level('aband_ef')} as risco_ef,
         {rate_level('aband_em')} as risco_em,
         row_number() over (order by ent, ano) - 1 as id_linha
  from panel),
fact as (
  select f.*, {index(recipe.INDEX_WEIGHTS, 2)} as indice_risco from (
    select u.*, {', '.join(CONTEXT_RATES)}
    from units u join (select ano, {', '.join(CONTEXT_RATES)} from ctx) using (ano)) f)"""

SCORED = f"scored as (select *, {index(recipe.SCORE_WEIGHTS, 1)} as score from panel)"

PRED = """
preds as (
  select *, 1::double + 0.25::double * coalesce(tdi_em, 25::double)
            + 0.5::double * aband_ef as pred
  from panel where aband_em is not null)"""

DOUBLED = "doubled as (select * from panel union all select * from panel where ent % 5 = 0)"

BASE = f"with {PANEL}"
P_DOUBLED = f"{BASE}, {DOUBLED}"
P_SCORED = f"{BASE}, {SCORED}"
P_PRED = f"{BASE}, {PRED}"
P_YEAR = f"{BASE}, {CONTEXT}, {YEARLY}"
P_FACT = f"{P_YEAR}, {FACT}"


def long(source: str, cols, ids=()) -> str:
    """Wide to long, null values kept."""
    keep = "".join(f"{i}, " for i in ids)
    return " union all ".join(
        f"select {keep}'{c}' as indicator, {c}::double as value from {source}" for c in cols
    )


def _describe(source: str, cols, stats: str) -> str:
    return f"select indicator, {stats} from ({long(source, cols)}) where value is not null group by 1"


def _missing(source: str, table: str, cols) -> str:
    return " union all ".join(
        f"select '{table}' as tabela, count(*) as n_linhas, {len(cols)}::int as n_colunas,"
        f" '{c}' as coluna, sum(case when {c} is null then 1 else 0 end)::bigint as valores_ausentes"
        f" from {source}" for c in cols
    )


PANEL_COLS = ["ent", "ano", *INDICATORS]
CONTEXT_COLS = ["ano", *CONTEXT_RATES]
UNIT_COLS = [*PANEL_COLS, "periodo", "risco_ef", "risco_em"]
FACT_COLS = [*UNIT_COLS, *CONTEXT_RATES, "indice_risco"]
REPORT = " union all ".join([
    _missing("doubled", "panel_bruta", PANEL_COLS),
    _missing("context", "context_bruta", CONTEXT_COLS),
    _missing("units", "panel_processada", UNIT_COLS),
    _missing("fact", "fato_processada", FACT_COLS),
])
P_REPORT = f"{P_FACT}, {DOUBLED}, report as ({REPORT})"


def _corr(a: str, b: str, digits: int, extra: str = "") -> str:
    r = (f"case when regr_sxx({b}, {a}) * regr_syy({b}, {a}) > 0 then "
         f"regr_sxy({b}, {a}) / sqrt(regr_sxx({b}, {a}) * regr_syy({b}, {a})) end")
    return (f"select '{a}' as a, '{b}' as b, {rnd(r, digits)} as r,"
            f" regr_count({b}, {a})::bigint as n from fact")


def _corrs(pairs, digits: int = 6) -> str:
    return " union all ".join(_corr(a, b, digits) for a, b in pairs)


CORR_PAIRS = [("aprov_em", "aband_em"), ("tdi_em", "aband_em"),
              ("reprov_em", "aband_em"), ("aband_ef", "aband_em")]
LINE_PAIRS = [("tdi_em", "aband_em"), ("tdi_em", "aband_ef"), ("reprov_em", "aband_em")]


def _line(x: str, y: str) -> str:
    return (
        f"select '{x}' as x, '{y}' as y, count(*) as n, {rnd(f'regr_slope({y}, {x})', 4)} as slope,"
        f" {rnd(f'regr_intercept({y}, {x})', 4)} as intercept, {rnd(f'avg({x})', 4)} as mean_x,"
        f" {rnd(f'avg({y})', 4)} as mean_y from panel where {x} is not null and {y} is not null"
    )


BOX = f"""
present as (select ent, ano, {period()} as periodo, aband_em from panel where aband_em is not null),
quart as (
  select periodo, quantile_cont(aband_em, 0.25) q1, quantile_cont(aband_em, 0.5) q2,
         quantile_cont(aband_em, 0.75) q3 from present group by 1),
fenced as (
  select p.*, q1, q2, q3,
         aband_em between q1 - (q3 - q1) * 1.5 and q3 + (q3 - q1) * 1.5 as inside
  from present p join quart using (periodo))"""


def _pct(c: str, partition: str = "") -> str:
    prev = f"lag({c}) over ({partition} order by ano)"
    return rnd(f"case when {prev} <> 0 then ({c} - {prev}) / {prev} * 100::double end", 2)


def _avg_if(cond: str, v: str) -> str:
    return f"avg(case when {cond} then {v} end)"


def _top_names(direction: str, n: int) -> str:
    items = ", ".join(f"{{'v': {c}, 'i': {i}, 'name': '{c}'}}" for i, c in enumerate(INDICATORS))
    return items


SHOCK, WINDOW = recipe.SHOCK_WINDOW, recipe.BASELINE_WINDOW
THREE = ["evasao_em", "aband_em", "tdi_em"]
SIX = ["evasao_ef", "evasao_em", "aband_ef", "aband_em", "tdi_em", "atu_em"]
KPI = ["evasao_ef", "evasao_em", "aband_em", "tdi_em", "indice_risco"]


def _diagnose() -> str:
    ok, warn, bad = settings.DIAGNOSIS_LEVELS
    rows = " union all ".join(
        f"select ano, '{c}' as indicator, case when {c} >= {hi} then '{bad}' when {c} >= {lo}"
        f" then '{warn}' else '{ok}' end as nivel from latest where {c} is not null"
        for c, (lo, hi) in recipe.DIAGNOSIS_LIMITS.items()
    )
    return (f"{P_YEAR}, latest as (select * from yearly order by ano desc limit 1)"
            f" select ano, nivel, count(*) as n, string_agg(indicator, ',' order by indicator)"
            f" as indicadores from ({rows}) group by 1, 2")


def _better() -> str:
    rows = " union all ".join(
        f"select {'-1' if lower else '1'} * ((select {c} from yearly order by ano desc limit 1)"
        f" - (select {c} from yearly order by ano limit 1)) as gain"
        for c, lower in recipe.LOWER_IS_BETTER.items()
    )
    return (f"{P_YEAR}, g as ({rows}), t as (select count(gain) as total,"
            f" coalesce(sum(case when gain > 0 then 1 else 0 end), 0)::bigint as melhorias from g)"
            f" select total, melhorias, case when total = 0 then null when melhorias = total"
            f" then 'todos' when melhorias >= total // 2 then 'maioria' else 'minoria' end"
            f" as veredito from t")


def _cards() -> str:
    names = {"taxa_abandono_em": "aband_em", "tdi_em": "tdi_em",
             "taxa_repetencia_em": "repet_em", "atu_em": "atu_em"}
    parts = []
    for i, (urgency, title, text, column, digits) in enumerate(settings.ACTIONS, 1):
        if column:
            before, after = text.replace("%%", "%").split("%s")
            value = f"'{before}' || {one(f'coalesce({names[column]}, 0)', digits)} || '{after}'"
        else:
            value = f"'{text}'"
        parts.append(f"select {i}::int as ordem, '{urgency}' as urgencia, '{title}' as titulo,"
                     f" {value} as indicador from latest")
    return (f"{P_YEAR}, latest as (select * from yearly order by ano desc limit 1) "
            + " union all ".join(parts))


def _extremes() -> str:
    return (f"{P_YEAR}, l as ({long('yearly', THREE, ['ano'])}) select indicator,"
            f" first(ano order by value desc, ano) as ano_max, {rnd('max(value)', 1)} as val_max,"
            f" first(ano order by value, ano) as ano_min, {rnd('min(value)', 1)} as val_min"
            f" from l where value is not null group by 1")


def _compare() -> str:
    b = _avg_if(f"ano between {WINDOW[0]} and {WINDOW[1]}", "value")
    s = _avg_if(f"ano between {SHOCK[0]} and {SHOCK[1]}", "value")
    return (f"{P_YEAR}, l as ({long('yearly', THREE, ['ano'])}), m as (select indicator, {b} as b,"
            f" {s} as s, first(ano order by value desc nulls last, ano) as peak from l group by 1)"
            f" select indicator, {rnd('b', 1)} as media_base, {rnd('s', 1)} as media_choque,"
            f" {rnd('s - b', 1)} as diferenca, peak between {SHOCK[0]} and {SHOCK[1]}"
            f" as pico_no_choque from m where b is not null and s is not null")


def _histogram() -> str:
    cols = ["aband_em", "aband_ef", "tdi_em"]
    return f"""{BASE}, l as (select * from ({long('panel', cols)}) where value is not null),
    e as (select indicator, min(value) lo, max(value) hi, avg(value) m, median(value) md
          from l group by 1)
    select indicator, bin, count(*) as n, {rnd('any_value(m)', 4)} as mean,
           {rnd('any_value(md)', 4)} as median
    from (select l.indicator, m, md, case when hi > lo then
            least(floor((value - lo) / ((hi - lo) / 25::double)) + 1, 25)::int else 1 end as bin
          from l join e using (indicator)) group by 1, 2"""


def _row_tops() -> str:
    union = long("panel", INDICATORS, ["ent", "ano"])
    order = "case indicator " + " ".join(
        f"when '{c}' then {i}" for i, c in enumerate(INDICATORS)) + " end"
    return f"""{BASE}, l as (select *, {order} as i from ({union}) where value is not null),
    r as (select *, row_number() over (partition by ent, ano order by value desc, i) d,
                 row_number() over (partition by ent, ano order by value, i) a from l)
    select ent, ano,
      string_agg(indicator, ',' order by d) filter (where d <= 3) as maiores,
      string_agg(indicator, ',' order by a) filter (where a <= 2) as menores
    from r group by 1, 2"""


def _shares(cols, where: str = "true") -> str:
    return " union all ".join(
        f"select '{c}' as coluna, sum(case when {c} is null then 1 else 0 end)::double"
        f" / count(*) as frac_ausentes from panel where {where}" for c in cols
    )


TRAIN = f"ano <= {recipe.SPLIT_YEAR}"
TEST = f"ano > {recipe.SPLIT_YEAR}"
GAP = "aband_em - pred"
METRICS = f"""select ano, count(*) as n, {rnd(f'avg(abs({GAP}))', 6)} as mae,
  {rnd(f'sqrt(avg(({GAP}) * ({GAP})))', 6)} as rmse,
  {rnd(f'1 - sum(({GAP}) * ({GAP})) / (var_pop(aband_em) * count(*))', 6)} as r2
  from preds group by ano"""

LEVELS = (f"select ent, ano, aband_ef, aband_em, {rate_level('aband_ef')} as risco_ef,"
          f" {rate_level('aband_em')} as risco_em from panel")

ORACLE: dict[str, str] = {
    "scan_typed": f"{BASE} select * from panel",
    "sink_roundtrip": f"{BASE} select * from panel",
    "dedup_rows": f"{P_DOUBLED} select distinct * from doubled",
    "duplicate_counts": f"{P_DOUBLED} select count(*) as n_rows, (select count(*) from"
    " (select distinct * from doubled)) as n_distinct, count(*) - (select count(*) from"
    " (select distinct * from doubled)) as n_removed from doubled",
    "clean_rates": f"{BASE} select ent::varchar as ent, ano, "
    + ", ".join(f"case when {c} is not null then least(greatest({c} * 4 - 60, 0::double),"
                f" 100::double) end as {c}" for c in RATES) + ", atu_em from panel",
    "coerce_numeric": "select event_id, case when event_id % 5 = 0 or event_id % 7 = 0 then null"
    " else try_cast(regexp_extract(props, '\"k\": *([^,}]*)', 1) as double) end as k from events",
    "period_label": f"{BASE} select ent, ano, {period()} as periodo from panel",
    "period_label_alt": f"{BASE} select ent, ano,"
    f" {_periods('ano', recipe.PERIODS_ALT, recipe.PERIODS_ALT_LAST)} as periodo from panel",
    "risk_level": f"{BASE} {LEVELS}",
    "score_level": f"{P_SCORED} select ent, ano, score, {score_level('score')} as nivel from scored",
    "pred_level": f"{P_PRED} select ent, ano, pred, {pred_level('pred')} as faixa from preds",
    "diagnose_thresholds": _diagnose(),
    "dense_row_id": f"{BASE} select ent, ano, row_number() over (order by ano, ent) - 1"
    " as id_linha from panel",
    "risk_index": f"{P_FACT} select ent, ano, indice_risco from fact",
    "risk_score": f"{P_SCORED} select ent, ano, score from scored",
    "level_ratio": f"{P_YEAR}, r as (select ano, {rnd('evasao_em / evasao_ef', 2)} as razao"
    " from yearly where evasao_em is not null and evasao_ef > 0)"
    f" select count(*) as n, {rnd('avg(razao)', 1)} as media, {rnd('max(razao)', 1)} as maximo,"
    " first(ano order by razao desc, ano) as ano_max from r",
    "year_filter": f"{BASE} select * from panel where ano between 1997 and 1999",
    "last_n_years": f"{BASE} select * from panel where ano in (select distinct ano from panel"
    " order by ano desc limit 4)",
    "at_risk": f"{BASE} select * from panel where coalesce(aband_em >= 10, false)"
    " or coalesce(aband_ef >= 5, false)",
    "drop_nulls": f"{BASE} select * from panel where aband_em is not null"
    " and (tdi_em is not null or had_em is not null)",
    "identity_check": f"{BASE}, g as (select ano, abs(aprov_em + reprov_em + aband_ef - 100) as gap"
    " from panel) select ano, count(*) as n_complete, sum(case when gap > 3 then 1 else 0"
    f" end)::bigint as n_broken, {rnd('max(gap)', 6)} as max_gap from g where gap is not null"
    " group by ano",
    "year_integrated": f"{P_YEAR} select * from yearly",
    "fact_integrated": f"{P_FACT} select * from fact",
    "unique_ids": f"{P_FACT} select count(*) as n_rows, count(distinct id_linha) as n_ids,"
    " count(*) = count(distinct id_linha) as unico from fact",
    "lookup_first": f"{P_YEAR} select c.ano, evasao_em, (select p.had_em from panel p where"
    " p.ano = c.ano and p.had_em is not null order by p.ent limit 1) as had_em from ctx c",
    "distinct_on_year": f"{BASE} select distinct on (ano) ano, ent, aband_ef from panel"
    " order by ano, ent",
    "yearly_means": f"{BASE} select ano, "
    + ", ".join(f"{rnd(f'avg({c})', 2)} as {c}" for c in INDICATORS) + " from panel group by ano",
    "missing_by_column": f"{P_REPORT} select *, {rnd('100 * valores_ausentes / n_linhas', 2)}"
    " as pct_ausentes, rank() over (partition by tabela order by valores_ausentes desc)::int"
    " as rank_na_tabela from report",
    "missing_global": f"{P_REPORT} select tabela, sum(n_linhas)::bigint as total_celulas,"
    " sum(valores_ausentes)::bigint as total_ausentes,"
    f" {rnd('100 * sum(valores_ausentes) / sum(n_linhas)', 4)} as pct_ausentes"
    " from report group by 1",
    "table_shapes": f"{P_REPORT} select split_part(replace(tabela, 'fato_', 'integracao_'), '_', 1)"
    " as fonte, split_part(tabela, '_', 2) as etapa, any_value(n_linhas) as n_linhas,"
    " any_value(n_colunas) as n_colunas from report group by 1, 2",
    "describe_long": f"{BASE} " + _describe(
        "panel", INDICATORS, "count(*) as n, " + ", ".join(
            f"{rnd(e, 2)} as {n}" for n, e in (
                ("mean", "avg(value)"), ("std", "stddev_samp(value)"), ("min", "min(value)"),
                ("q25", "quantile_cont(value, 0.25)"), ("q50", "quantile_cont(value, 0.5)"),
                ("q75", "quantile_cont(value, 0.75)"), ("max", "max(value)")))),
    "exec_summary": f"{P_FACT} " + _describe("fact", SIX, ", ".join(
        f"{rnd(e, 1)} as {n}" for n, e in (
            ("mean", "avg(value)"), ("median", "median(value)"), ("max", "max(value)"),
            ("min", "min(value)")))),
    "corr_matrix": f"{P_FACT} {_corrs([(b, a) for a, b in combinations(ALL, 2)])}",
    "corr_target": f"{P_FACT} {_corrs([(c, 'aband_em') for c in ALL if c != 'aband_em'])}",
    "corr_strength": f"{P_FACT} select *, case when r is null then null when abs(r) > 0.8 then"
    f" 'muito forte' when abs(r) > 0.6 then 'forte' else 'moderada' end as forca"
    f" from ({_corrs(CORR_PAIRS)})",
    "corr_findings": f"{P_FACT} select *, case when r < -0.4 then '{settings.CORR_INVERSE_TEXT}'"
    f" else '{settings.CORR_DIRECT_TEXT}' end as direcao from ({_corrs(CORR_PAIRS, 2)})"
    " where abs(r) > 0.4",
    "trend_line": f"{BASE} " + " union all ".join(_line(x, y) for x, y in LINE_PAIRS),
    "trend_points": f"{BASE}, f as (select regr_slope(aband_em, tdi_em) s,"
    " regr_intercept(aband_em, tdi_em) i, min(tdi_em) lo, max(tdi_em) hi from panel"
    " where aband_em is not null and tdi_em is not null),"
    " p as (select step::int as step, s, i, lo + (hi - lo) * step / 99::double as x"
    " from f, range(100) t(step))"
    f" select step, {rnd('x', 4)} as x, {rnd('s * x + i', 4)} as y from p",
    "histogram25": _histogram(),
    "boxplot_period": f"{BASE}, {BOX} select periodo, count(*) as n, {rnd('any_value(q1)', 6)} as q1,"
    f" {rnd('any_value(q2)', 6)} as q2, {rnd('any_value(q3)', 6)} as q3,"
    f" {rnd('min(case when inside then aband_em end)', 6)} as whisker_low,"
    f" {rnd('max(case when inside then aband_em end)', 6)} as whisker_high,"
    " sum(case when inside then 0 else 1 end)::bigint as n_outliers from fenced group by 1",
    "outliers_period": f"{BASE}, {BOX} select ent, ano, periodo, aband_em from fenced"
    " where not inside",
    "extreme_years": _extremes(),
    "extreme_changes": f"{P_YEAR}, c as (select ano, {_pct('evasao_em')} as v from yearly),"
    " k as (select * from c where v is not null) select 'evasao_em' as indicator,"
    " (select ano from k order by v desc, ano limit 1) as ano_pior,"
    f" {rnd('(select max(v) from k)', 2)} as var_pior,"
    " (select ano from k order by v, ano limit 1) as ano_melhor,"
    f" {rnd('(select min(v) from k)', 2)} as var_melhor",
    "series_delta": f"{P_YEAR}, l as (select * from ({long('yearly', THREE, ['ano'])})"
    " where value is not null), e as (select indicator, min(ano) as ano_ini, max(ano) as ano_fim,"
    f" {rnd('first(value order by ano)', 1)} as val_ini,"
    f" {rnd('first(value order by ano desc)', 1)} as val_fim from l group by 1)"
    f" select *, {rnd('val_fim - val_ini', 1)} as delta from e",
    "latest_vs_prev": f"{P_YEAR}, s as (select ano, {rnd('indice_risco', 1)} as s, row_number()"
    " over (order by ano desc) rn from yearly where indice_risco is not null),"
    " t as (select max(ano) as ano_score, max(case when rn = 1 then s end) as score_atual,"
    " coalesce(max(case when rn = 2 then s end), max(case when rn = 1 then s end)) as score_ant"
    f" from s where rn <= 2) select *, {score_level('score_atual')} as nivel_score from t",
    "kpi_cards": f"{P_YEAR}, l as (select *, lag(value) over (partition by indicator order by ano)"
    " as p, row_number() over (partition by indicator order by ano desc) as rn"
    f" from ({long('yearly', KPI, ['ano'])})) select indicator, ano, {rnd('value', 1)} as valor,"
    f" {rnd('value - p', 1)} as delta_pp, case when value is null then null when value > 10 then"
    " 'critico' when value > 5 then 'atencao' else 'positivo' end as situacao from l where rn = 1",
    "improvement_count": _better(),
    "shock_means": f"{P_YEAR}, m as (select {_avg_if(f'ano < {SHOCK[0]}', 'indice_risco')} as a,"
    f" {_avg_if(f'ano between {SHOCK[0]} and {SHOCK[1]}', 'indice_risco')} as d,"
    f" {_avg_if(f'ano > {SHOCK[1]}', 'indice_risco')} as p from yearly) select"
    f" {rnd('a', 1)} as antes, {rnd('d', 1)} as durante, {rnd('p', 1)} as depois,"
    f" {rnd('d - a', 1)} as diferenca from m",
    "period_compare": _compare(),
    "distinct_years": f"{BASE} select (select string_agg(ano::varchar, ',' order by ano) from"
    " (select distinct ano from panel)) as anos, count(distinct ano) as n_anos,"
    " count(distinct ent) as n_ent from panel",
    "sparse_columns": f"{BASE} select *, frac_ausentes > 0.3 as esparsa from"
    f" ({_shares(INDICATORS, TRAIN)})",
    "rows_with_any_null": f"{BASE} select count(*) as n_linhas, sum(case when "
    + " or ".join(f"{c} is null" for c in INDICATORS)
    + f" then 1 else 0 end)::bigint as n_com_ausente from panel where {TRAIN}",
    "best_per_group": f"{P_PRED}, e as (select ano, ent, abs(pred - aband_em) as erro from preds),"
    " b as (select *, row_number() over (partition by ano order by erro, ent) rn from e)"
    f" select ano, {rnd('erro', 6)} as erro, ent, ano = (select ano from b where rn = 1"
    " order by erro, ano limit 1) as melhor_geral from b where rn = 1",
    "project_trend": f"{P_SCORED}, y as (select ano, avg(score) as s from scored where score is"
    " not null group by ano), f as (select regr_slope(s, ano) m, regr_intercept(s, ano) i,"
    " max(ano) hi, count(*) n from y), p as (select (hi + k)::int as ano,"
    f" {rnd('greatest(0::double, m * (hi + k) + i)', 1)} as score_estimado from f,"
    f" range(1, 3) t(k) where n >= 4) select *, {score_level('score_estimado')}"
    " as nivel_estimado from p",
    "regression_metrics": f"{P_PRED} {METRICS}",
    "yoy_change": f"{P_YEAR}, c as (select ano, "
    + ", ".join(f"{c}, {_pct(c)} as var_{c}" for c in [*THREE, "indice_risco"])
    + " from yearly) select *, case when var_evasao_em > 0 then 'worse' when var_evasao_em"
    " is not null then 'better' end as sentido_evasao_em from c",
    "yoy_change_by_unit": f"{BASE} select ent, ano, "
    + ", ".join(f"{c}, {_pct(c, 'partition by ent')} as var_{c}" for c in ("aband_em", "tdi_em"))
    + " from panel",
    "risk_rank_dense": f"{P_PRED} select ent, ano, pred, dense_rank() over (order by pred desc)"
    f" as posicao from preds where {TEST}",
    "top_risk": f"{P_PRED} select ent, ano, aband_em, pred from preds where {TEST}"
    " order by pred desc, ent, ano limit 15",
    "top_missing": f"{BASE} select * from ({_shares(INDICATORS)})"
    " order by frac_ausentes desc, coluna limit 5",
    "row_top_indicators": _row_tops(),
    "union_splits": f"{P_PRED} select ent, ano, aband_em, pred, 'treino' as split, null as faixa"
    f" from preds where {TRAIN} union all select ent, ano, aband_em, pred, 'teste',"
    f" {pred_level('pred')} from preds where {TEST}",
    "format_pp": f"{BASE}, c as (select ent, ano, aband_em, {_pct('aband_em', 'partition by ent')}"
    f" as v from panel) select ent, ano, {one('aband_em')} || '%' as texto,"
    f" {plus('v')} || ' p.p.' as variacao from c",
    "format_params": f"{BASE} select ent, ano, case ent % 3 when 0 then 'boosting' when 1 then"
    " 'tree' else 'knn' end as algoritmo, case ent % 3 when 0 then concat_ws(', ', 'lr=' || "
    f"{one('had_em', 2)}, 'depth=' || {one('tdi_em', 0)}, 'leaf=' || {one('atu_em', 0)})"
    f" when 1 then concat_ws(', ', 'depth=' || {one('tdi_em', 0)}, 'leaf=' || {one('atu_em', 0)})"
    f" else concat_ws(', ', 'k=' || {one('atu_em', 0)}, 'weights=distance') end as parametros"
    " from panel",
    "summary_json": f"{P_PRED}, m as ({METRICS}) select ano, '{{\"ano\":' || ano || ',\"n\":' || n"
    f" || ',\"mae\":\"' || {one('mae', 4)} || '\",\"rmse\":\"' || {one('rmse', 4)} || '\"}}'"
    " as resumo from m",
    "series_long": f"{P_YEAR} select * from ("
    + long("yearly", [c for c in ALL if c.endswith("_em")], ["ano"]) + ") where value is not null",
    "paired_series": f"{P_YEAR} select ano, evasao_em, aband_em from yearly"
    " where evasao_em is not null and aband_em is not null",
    "summary_by_year": f"{P_YEAR} select ano, "
    + ", ".join(f"{rnd(c, 2)} as {c}" for c in SIX) + " from yearly",
    "null_mask": f"{BASE} select ano, ent, "
    + ", ".join(f"case when {c} is null then 1 else 0 end::int as falta_{c}" for c in INDICATORS)
    + " from panel order by ano, ent limit 30",
    "action_cards": _cards(),
}
