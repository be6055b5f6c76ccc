"""The whole modelling run on the smallest tables, with few and small fits."""

import pytest

from panelrisk import settings
from panelrisk.ml import store, tune
from panelrisk.plans import model_queries, suite
from panelrisk.plans.inputs import UNIT_KEYS, joined_rows
from panelrisk.plans.model_queries import CATEGORICAL, NUMERIC, PROFILE
from panelrisk.sources import panel as recipe
from panelrisk.sources.panel import TARGET
from panelrisk.sources.tables import (
    append_rows, parquet_tables, read_or_build, save_catalog_tables,
)


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("suite"))
    options = suite.SuiteOptions(
        TARGET, UNIT_KEYS, NUMERIC, CATEGORICAL, recipe.SPLIT_YEAR,
        {"max_depth": 2, "max_iter": 2, "min_leaf": 2}, {}, 3, (2, 3), (42,),
        {"stepSize": (0.3,), "maxDepth": (2,), "maxIter": (2, 3), "minInstancesPerNode": (2,)},
        2, 2, PROFILE,
    )
    return suite.run_suite(joined_rows(spark, small), options, folder), folder


def test_tables(spark, run):
    tables, folder = run
    scored = tables["scored"]
    test, train = scored.where("split = 'teste'"), scored.where("split = 'treino'")
    assert train.where("posicao_risco is not null").count() == 0
    ranks = [(r["pred_final"], r["posicao_risco"]) for r in test.collect()]
    order = sorted({p for p, _ in ranks}, reverse=True)
    assert all(order.index(p) + 1 == n for p, n in ranks)
    assert scored.count() == scored.select(*UNIT_KEYS).distinct().count()
    assert tables["metrics"].count() == 4
    assert tables["runs"].where("parent_id is not null").count() == 4
    assert tables["cv_folds"].count() == 4 and tables["cv_summary"].count() == 1
    assert tables["kmeans_curve"].where("escolhido").count() == 1
    assert tables["learning_curve"].count() >= 2
    parsed = suite.read_summary(spark, folder)
    assert {r["modelo"] for r in parsed.where("mae is not null").collect()} == {
        "pred_boosting", "pred_tree", "pred_knn", "pred_final"}
    assert suite.read_summary(spark, folder + "/nothing") is None


def test_saved_model_scores_new_rows(spark, small, run):
    model = store.load_model(spark, f"{run[1]}/final_model")
    assert model.cutoff == recipe.SPLIT_YEAR and model.target == TARGET
    rows = joined_rows(spark, small)
    assert model.predict(rows).where("pred is null").count() == 0
    with pytest.raises(ValueError, match="tdi_em"):
        model.predict(rows.drop("tdi_em"))


def test_helpers(spark, small, tmp_path):
    tables = parquet_tables(spark, small, ["nation", "region"])
    save_catalog_tables(tables)
    save_catalog_tables(tables)
    assert spark.table("default.nation").count() == tables["nation"].count()
    path = str(tmp_path / "built")
    calls = []

    def build(session):
        calls.append(1)
        return tables["region"]

    for _ in range(2):
        assert read_or_build(spark, path, build).count() == tables["region"].count()
    assert len(calls) == 1
    append_rows(tables["region"], path)
    assert spark.read.parquet(path).count() == 2 * tables["region"].count()


def test_ranking_searches_the_whole_space(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(model_queries, "joined_rows", lambda spark, folder: None)
    monkeypatch.setattr(suite, "scored_table", lambda rows, options: asked.append(options) or (rows, {}))
    model_queries.risk_ranking(spark, "nowhere")
    o = asked[0]
    assert o.space == settings.SEARCH_SPACE and (o.draws, o.splits) == (18, 4)
    assert len(tune.draw_settings(o.space, o.draws)) == 18
    assert tuple(o.ks) == (2, 3, 4, 5, 6, 7, 8) and len(set(o.starts)) == 10
    # the boosting and the tree of their own defaults: 200 trees of depth 5, one of depth 4
    assert not o.boosting and not o.tree and o.neighbours == 5
