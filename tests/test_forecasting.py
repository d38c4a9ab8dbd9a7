import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.fixtures import clusters, rows, totals
from trendcast.operators import backtest, features, metrics, models, ols, recursive, segmented, splits

WINDOWS = [splits.Window(2000, 2001, 2005), splits.Window(2005, 2006, 2010), splits.Window(2010, 2011, 2016)]
NAMES = list(features.SEGMENT_FEATURES)
COLLINEAR = [(2000, 10, 1, 8.0, 6.0, 0.1), (2001, 12, 2, 10.0, 8.0, 0.2), (2002, 14, 3, 12.0, 10.0, 0.1),
             (2003, 16, 4, 14.0, 12.0, 0.1), (2004, 18, 5, 16.0, 14.0, 0.1), (2005, 20, 6, 18.0, 16.0, 0.1)]


@pytest.fixture(scope="module")
def table(spark):
    return features.lag_table(totals(spark), (), "year").persist()


@pytest.fixture(scope="module")
def model_rows(table):
    return features.model_rows(table, NAMES, "n", (), "year").persist()


@pytest.fixture(scope="module")
def collinear(spark):
    return spark.createDataFrame(
        COLLINEAR, "period int, n long, trend int, lag_1 double, lag_2 double, growth_rate_lag_1 double")


def test_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("a", 0.0, 1.0), ("b", 0.0, 3.0)], "k string, actual double, predicted double")
    out = metrics.forecast_metrics(df, ["k"]).orderBy("k")
    assert rows(out, "MAE", "RMSE", "MAPE") == [(1.0, 1.0, 50.0), (3.0, 3.0, None)]


def test_naive_on_the_collinear_rows(collinear):
    p, _ = backtest.fixed_evaluation(collinear, ["lag_1"], [models.NAIVE], 2002, 2004)
    out = metrics.forecast_metrics(p, ["split"]).orderBy("split")
    assert rows(out, "split", "MAE", "RMSE", "MAPE") == [("test", 2.0, 2.0, 10.0), ("validation", 2.0, 2.0, 11.8056)]


def test_least_squares_survives_collinear_features(collinear):
    p, _ = backtest.fixed_evaluation(collinear, ["trend", "lag_1", "lag_2"], [models.LINEAR], 2002, 2004)
    assert rows(p.orderBy("period"), "predicted") == [(pytest.approx(v),) for v in (16, 18, 20)]


def test_minimum_norm_solution(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 6.0)], "a double, b double, n double")
    row = ols.fit_ols(df, ["a", "b"]).first()
    assert row["coef"] == [pytest.approx(0.6), pytest.approx(1.2)] and row["n_rows"] == 2


def test_one_feature_matches_the_general_path_and_a_constant_gets_slope_zero(spark):
    df = spark.createDataFrame([("x", 1.0, 3.0), ("x", 2.0, 5.0), ("x", 4.0, 8.0), ("c", 1.0, 3.0), ("c", 1.0, 5.0)],
                               "k string, a double, n double")
    out = {r["k"]: (r["intercept"], r["coef"][0]) for r in ols.fit_ols(df, ["a"], by=["k"]).collect()}
    slope, intercept = np.polyfit([1, 2, 4], [3, 5, 8], 1)
    assert out["x"] == (pytest.approx(intercept), pytest.approx(slope)) and out["c"] == (4.0, 0.0)


def test_naive_windows_against_known_values(model_rows):
    d = backtest.rolling_backtest(models.NAIVE, model_rows, NAMES, WINDOWS, "n", (), "year", clip=True)
    assert rows(d.orderBy("window_id"), "train_start", "n_train", "n_validation", "MAE", "RMSE", "MAPE") == [
        (1978, 23, 5, 82.0, 97.17, 15.2774), (1978, 28, 5, 109.6, 149.4376, 18.8315), (1978, 33, 6, 197.1667, 213.5427, 14.3267)]
    s = metrics.summarise_windows(d).first()
    assert s["average_RMSE"] == pytest.approx(153.38343333333333) and s["hyperparameters"] == "{}"


def test_windows_with_an_empty_side_are_skipped(model_rows):
    w = [*WINDOWS[:1], splits.Window(1970, 1971, 1975), splits.Window(2030, 2031, 2032)]
    for name in (models.NAIVE, models.LINEAR):
        assert backtest.rolling_backtest(name, model_rows, NAMES, w, "n", (), "year").count() == 1


def test_linear_ablation_against_known_values(table):
    out = backtest.ablation_table(
        table, features.ablation_sets(table.columns)[:3], WINDOWS, 2010, 2016, [models.LINEAR], "n", "year", clip=True)
    got = {r["feature_set"]: (r["n_features"], round(r["average_rolling_RMSE"], 4), r["test_RMSE"], r["test_MAPE"]) for r in out.collect()}
    assert got == {"trend_only": (1, 401.0474, 242.7195, 14.6183), "trend_plus_lags": (3, 283.2584, 296.4332, 18.6906),
                   "trend_lags_growth": (4, 287.9183, 295.1948, 18.6042)}
    assert [r["feature_set"] for r in out.collect()][0] == "trend_plus_lags"


def test_naive_future_repeats_the_last_value(table):
    out = recursive.forecast(recursive.forecast_start(table, period="year"), models.NaiveModel(), 5, period="year")
    assert rows(out, "year", "predicted") == [(y, 1177.0) for y in range(2026, 2031)]


def test_modes_differ_from_step_two_by_the_age_of_the_growth(table, model_rows):
    start = recursive.forecast_start(table, NAMES, period="year")
    fitted = models.fit_model(models.LINEAR, model_rows, NAMES)
    ref = recursive.forecast(start, fitted, 4, period="year", features=NAMES).collect()
    new = recursive.forecast(start, fitted, 4, period="year", features=NAMES, mode="consistent").collect()
    assert ref[0]["growth_rate_lag_1"] == ref[1]["growth_rate_lag_1"] == new[0]["growth_rate_lag_1"]
    assert ref[2]["growth_rate_lag_1"] == new[1]["growth_rate_lag_1"] == ref[1]["growth_rate"]
    assert ref[0]["predicted"] == new[0]["predicted"] and ref[1]["predicted"] != new[1]["predicted"]
    with pytest.raises(ValueError, match="mode"):
        recursive.forecast(start, fitted, 4, mode="other")


def test_fold_and_step_loop_agree(table, model_rows):
    """A linear model run through the step loop must give the fold's path, across a checkpoint."""
    class AsTable:
        def __init__(self, model):
            self.transform = model.transform

    start = recursive.forecast_start(table, NAMES, period="year")
    fitted = models.fit_model(models.LINEAR, model_rows, NAMES)
    fold = recursive.forecast(start, fitted, 5, period="year", features=NAMES, clip=True)
    loop = recursive.loop_forecast(start, AsTable(fitted), 5, period="year", features=NAMES, clip=True, checkpoint_every=2)
    assert loop.columns == fold.columns
    for a, b in zip(fold.collect(), loop.collect()):
        assert tuple(a) == pytest.approx(tuple(b))


def test_carried_shares_enter_every_step(spark):
    df = spark.createDataFrame([(p, 10 + p, 0.1 * p) for p in range(1, 9)], "period int, n long, kw_a_share double")
    t = features.lag_table(df, shares=["kw_a_share"])
    names = ["trend", "kw_a_share_lag_1"]
    coefs = spark.createDataFrame([(1.0, [0.0, 10.0])], "intercept double, coef array<double>")
    out = recursive.forecast_linear(recursive.forecast_start(t, names), coefs, names, 3)
    assert rows(out, "period", "kw_a_share_lag_1", "predicted") == [(p, pytest.approx(0.8), pytest.approx(9.0)) for p in (9, 10, 11)]


def test_segmented_linear_against_known_values(spark):
    r = segmented.segmented_forecast(
        clusters(spark), totals(spark), "numeric", [models.LINEAR], 2010, 2016, 5, period="year", clip=True)
    got = {(x["cluster"], x["split"]): (x["MAE"], x["RMSE"], x["MAPE"], x["n_clusters"]) for x in r.metrics.collect()}
    assert got == {
        (None, "validation"): (201.5943, 251.0946, 13.0062, 2), (None, "test"): (253.9676, 297.1905, 18.7353, 2),
        ("cluster_0", "validation"): (208.4079, 256.8242, 13.5328, None), ("cluster_0", "test"): (251.5257, 293.9592, 18.6099, None),
        ("cluster_1", "validation"): (11.9619, 12.9851, 381.6795, None), ("cluster_1", "test"): (4.9218, 5.1444, 159.1185, None)}
    future = {(x["cluster"], x["year"]): x["predicted"] for x in r.future.collect()}
    assert [future["aggregated_total", y] for y in range(2026, 2031)] == [1303.7786, 1326.7274, 1398.0314, 1448.9648, 1505.0437]
    assert [future["cluster_1", y] for y in range(2026, 2031)] == [7.1338, 8.1559, 8.7154, 9.0531, 9.2825]
    test = r.predictions.filter("split = 'test'").orderBy("year")
    assert rows(test, "actual", "predicted")[0] == (1599.0, 1782.7368) and test.count() == 9
    base = metrics.forecast_metrics(
        backtest.fixed_evaluation(
            features.model_rows(features.lag_table(totals(spark), (), "year"), NAMES, "n", (), "year"),
            NAMES, [models.LINEAR], 2010, 2016, period="year")[0], ["model", "split"])
    both = segmented.baseline_vs_segmented(segmented.baseline_rows(base), r.metrics)
    assert both.count() == 4 and both.columns == ["scheme", "model", "split", "MAE", "RMSE", "MAPE", "n_clusters"]


@pytest.mark.parametrize("tree_fit", segmented.TREE_FITS)
def test_segmented_trees(spark, tree_fit):
    r = segmented.segmented_forecast(
        clusters(spark), totals(spark), "numeric", [models.FOREST], 2010, 2016, 3, period="year", clip=True,
        params_by_model={models.FOREST: {"n_estimators": 5, "max_depth": 3}}, tree_fit=tree_fit)
    assert r.metrics.count() == 6 and r.predictions.count() == 15
    assert r.future.count() == 9 and r.future.filter("predicted < 0").count() == 0


@pytest.mark.parametrize("name, params", [
    (models.FOREST, {"n_estimators": 8, "max_depth": 4}), (models.BOOSTING, {"n_estimators": 4, "learning_rate": 0.2, "max_depth": 2})])
def test_tree_models(model_rows, table, name, params):
    d = backtest.rolling_backtest(name, model_rows, NAMES, WINDOWS[:2], "n", (), "year", params=params, clip=True)
    got = d.orderBy("window_id").collect()
    assert [r["n_train"] for r in got] == [23, 28] and all(0 < r["RMSE"] < 1000 for r in got)
    fitted = models.fit_model(name, model_rows, NAMES, params=params)
    future = recursive.forecast(recursive.forecast_start(table, NAMES, period="year"), fitted, 3, period="year", features=NAMES)
    low, high = model_rows.agg(F.min("n"), F.max("n")).first()
    assert all(low <= r["predicted"] <= high for r in future.collect()) and future.count() == 3
    importance = models.importance_table(model_rows.sparkSession, fitted)
    assert sum(v for (v,) in rows(importance, "importance")) == pytest.approx(1.0)


def test_tuning_and_recommendation(model_rows):
    grid = splits.parameter_grid({"n_estimators": [2, 6], "max_depth": [2]})
    tables, chosen = backtest.tune_tree_models(model_rows, NAMES, WINDOWS[:2], {models.FOREST: grid}, period="year")
    ranked = rows(tables[models.FOREST], "hyperparameters", "average_RMSE")
    assert len(ranked) == 2 and ranked[0][1] <= ranked[1][1] and chosen[models.FOREST] in grid
    assert backtest.best_parameters(tables[models.FOREST].limit(0)) == {}
    d = backtest.rolling_backtest(models.NAIVE, model_rows, NAMES, WINDOWS, "n", (), "year")
    p, _ = backtest.fixed_evaluation(model_rows, NAMES, [models.NAIVE, models.LINEAR], 2010, 2016, period="year")
    rec = backtest.recommend(metrics.summarise_windows(d), metrics.forecast_metrics(p, ["model", "split"]), chosen, True).collect()
    assert rec[0]["model"] == rec[1]["model"] == models.NAIVE
    assert rec[0]["selection_metrics"].startswith("average_RMSE=153.38343333333333, average_MAE=129.5889")
    assert rec[1]["selection_metrics"] == "RMSE=231.8314, MAE=197.3333, MAPE=14.3072"


def test_coefficients_list_the_intercept_first(model_rows):
    out = rows(models.coefficient_table(ols.fit_ols(model_rows, NAMES), NAMES), "feature", "coefficient")
    assert out[0][0] == "intercept" and [c for _, c in out[1:]] == sorted((c for _, c in out[1:]), reverse=True)


def test_unknown_model_is_an_error(model_rows):
    with pytest.raises(ValueError, match="unknown model"):
        models.fit_model("Oracle", model_rows, NAMES)


def test_many_series_equal_one_series_each(spark, model_rows):
    """The keyed back-test of copies must repeat the single-series result for each key."""
    keyed = model_rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3))))
    for name in (models.NAIVE, models.LINEAR):
        one = {tuple(r) for r in rows(backtest.rolling_backtest(name, model_rows, NAMES, WINDOWS, "n", (), "year"), "window_id", "RMSE")}
        many = rows(backtest.rolling_backtest(name, keyed, NAMES, WINDOWS, "n", ["k"], "year"), "k", "window_id", "RMSE")
        assert len(many) == 9 and {(w, r) for _, w, r in many} == one
