"""The table-building job on two small files with the usual defects."""

import pytest

from panelrisk.plans.etl import load_or_build, run_etl, yearly_table
from panelrisk.sources.schemas import FLOW_RAW, SCHOOL_RAW
from panelrisk.sources.tables import read_csv, read_or_none

FLOW_HEAD = [f.name for f in FLOW_RAW]
SCHOOL_HEAD = [f.name for f in SCHOOL_RAW]


def line(head, **values):
    base = {"id_municipio": "1", "id_municipio_nome": "Cidade"}
    return ",".join(str((base | values).get(c, "")) for c in head)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    flow = [line(FLOW_HEAD, ano=y, taxa_evasao_em=v, taxa_repetencia_em=10, taxa_evasao_ef=3)
            for y, v in ((2018, 20), (2018, 10), (2019, 8), (2021, 6))]
    school = [
        line(SCHOOL_HEAD, ano=2018, tdi_em=30, taxa_abandono_em=12, taxa_abandono_ef=1),
        line(SCHOOL_HEAD, ano=2018, tdi_em=30, taxa_abandono_em=12, taxa_abandono_ef=1),
        line(SCHOOL_HEAD, ano=2018, tdi_em=120, taxa_abandono_em="ruim", taxa_abandono_ef=6),
        line(SCHOOL_HEAD, ano=2019, tdi_em=20, taxa_abandono_em=5, taxa_abandono_ef=1),
        line(SCHOOL_HEAD, ano=2020, tdi_em=20, taxa_abandono_em=25),
    ]
    (folder / "flow.csv").write_text("\n".join([",".join(FLOW_HEAD), *flow]), encoding="utf-8-sig")
    (folder / "school.csv").write_text("\n".join([",".join(SCHOOL_HEAD), *school]))
    return str(folder / "flow.csv"), str(folder / "school.csv"), str(folder / "out")


@pytest.fixture(scope="module")
def tables(spark, files):
    return run_etl(spark, *files)


def test_csv_with_mark_and_bad_numbers(spark, files):
    assert read_csv(spark, files[0], FLOW_RAW).first()["ano"] == 2018
    raw = read_csv(spark, files[1], SCHOOL_RAW)
    assert raw.where("taxa_abandono_em is null").count() == 1


def test_counts(tables):
    counts = {k: v.count() for k, v in tables.items()}
    assert counts == {"fato_socioeconomico": 4, "fato_educacional": 4, "dim_socio_anual": 3,
                      "dim_educ_anual": 3, "dim_integrado_anual": 2, "fato_integrado": 3,
                      "escolas_risco": 3, "tendencia_anual": 2}


def test_school_rows(tables):
    rows = {r["id_linha_educacional"]: r for r in tables["fato_educacional"].collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert {r["tdi_em"] for r in rows.values()} == {30.0, 100.0, 20.0}
    assert {r["risco_em"] for r in rows.values()} == {"Alto", "Sem dado", "Baixo", "Crítico"}
    assert rows[0]["id_municipio_nome"] == "Cidade"


def test_yearly_and_index(tables):
    rows = {r["ano"]: r for r in tables["dim_integrado_anual"].collect()}
    assert rows[2018]["taxa_evasao_em"] == 15.0 and rows[2018]["id_municipio"] == "1"
    assert rows[2018]["indice_risco_evasao"] == round(0.4 * 15 + 0.3 * 65 + 0.3 * 10, 2)
    trend = {r["ano"]: r for r in tables["tendencia_anual"].collect()}
    assert trend[2019]["var_taxa_evasao_em"] == -46.67


def test_report_sums(spark, files, tables):
    detail = spark.read.parquet(f"{files[2]}/ausentes_detalhe.parquet")
    total = spark.read.parquet(f"{files[2]}/ausentes_resumo_global.parquet")
    by_table = {r["tabela"]: r["s"] for r in
                detail.groupBy("tabela").agg({"valores_ausentes": "sum"})
                .withColumnRenamed("sum(valores_ausentes)", "s").collect()}
    assert by_table == {r["tabela"]: r["total_ausentes"] for r in total.collect()}


def test_second_call_reads(spark, files, tables):
    again = load_or_build(spark, "/does/not/exist", "/does/not/exist", files[2])
    assert again["fato_integrado"].count() == 3
    assert read_or_none(spark, files[2] + "/nothing") is None


def test_yearly_table_from_parts(tables):
    parts = {k: tables[k] for k in ("dim_socio_anual", "dim_educ_anual")}
    assert yearly_table(parts).count() == 2
    assert yearly_table({}) is None
