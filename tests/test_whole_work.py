"""The catalog's models at their full counts."""

import pytest

from trendcast.operators import backtest, models, segment, splits, textvec, trees
from trendcast.plans import catalog

FOLDER = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


def recorded(monkeypatch, module, name):
    def stop(*args, **named):
        raise Seen(args, named)

    monkeypatch.setattr(module, name, stop)


def call(spark, name):
    with pytest.raises(Seen) as seen:
        catalog.QUERIES[name](spark, FOLDER)
    spark.catalog.clearCache()
    return seen.value.args


@pytest.mark.parametrize("name", ["forest_backtest", "pooled_forest_backtest", "model_recommendation"])
def test_back_tests_use_the_default_counts(spark, monkeypatch, name):
    recorded(monkeypatch, backtest, "rolling_backtest")
    assert call(spark, name)[1].get("params") is None


def test_boosting_uses_the_default_counts(spark, monkeypatch):
    recorded(monkeypatch, trees, "backtest_grid")
    args, _ = call(spark, "boosting_backtest")
    assert args[0] == models.BOOSTING and args[4] == [{}]


def test_tuning_covers_both_grids(spark, monkeypatch):
    recorded(monkeypatch, trees, "tune_jointly")
    args, _ = call(spark, "tree_tuning")
    assert {m: len(g) for m, g in args[3].items()} == {models.FOREST: 27, models.BOOSTING: 27}


@pytest.mark.parametrize("name,function,grid", [
    ("text_segmentation", "text_segmentation", True), ("text_options", "text_segmentation", True),
    ("numeric_segmentation", "numeric_segmentation", False), ("k_selection", "choose_k", False)])
def test_segmentation_uses_all_restarts_and_options(spark, monkeypatch, name, function, grid):
    recorded(monkeypatch, segment, function)
    args, named = call(spark, name)
    assert named.get("restarts", segment.RESTARTS) == segment.RESTARTS
    assert not grid or textvec.TEXT_GRID in args


def test_kmeans_uses_all_restarts(spark, monkeypatch):
    recorded(monkeypatch, segment, "fit_kmeans")
    assert len(call(spark, "kmeans_assignment")[0][2]) == segment.RESTARTS


def test_first_rounds_equal_a_shorter_fit(spark):
    df = spark.createDataFrame([(i, float(i * i % 17), i) for i in range(30)], "trend int, n double, period int")
    grid = [{"n_estimators": n, "max_depth": 2, "learning_rate": 0.1} for n in (2, 6)]
    long, short = (models.fit_model(models.BOOSTING, df, ["trend"], params=p) for p in reversed(grid))
    shorter = models.first_rounds(long, 2)
    assert shorter.transform(df).select("predicted").collect() == short.transform(df).select("predicted").collect()
    windows = [splits.Window(19, 20, 29)]
    tuned = {r.hyperparameters: r.average_RMSE for r in backtest.tune(models.BOOSTING, df, ["trend"], windows, grid).collect()}
    for p in grid:
        alone = backtest.rolling_backtest(models.BOOSTING, df, ["trend"], windows, params=p).first()
        assert tuned[alone.hyperparameters] == alone.RMSE
