"""The queries that return the models' own columns, against plain Python."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from trendcast.operators import backtest, models, segment, trees
from trendcast.plans import catalog
from trendcast.plans.bindings import VAL_END, WINDOWS

FOLDER = "/root/testdata/sf0.001"
SMALL = {models.FOREST: {"n_estimators": 4}, models.BOOSTING: {"n_estimators": 3}}


@pytest.fixture
def quick(monkeypatch):
    """Small fits: what is tested is what becomes of them."""
    fit = models.fit_model

    def small(name, df, features, target="n", params=None, seed=42):
        return fit(name, df, features, target, SMALL.get(name), seed)

    monkeypatch.setattr(models, "fit_model", small)
    monkeypatch.setattr(backtest, "fit_model", small)
    for name in ("numeric_segmentation", "text_segmentation"):
        monkeypatch.setattr(segment, name, partial(getattr(segment, name), k_values=(2, 3), restarts=1))
    monkeypatch.setattr(segment, "RESTARTS", 2)


def run(spark, name):
    out = catalog.QUERIES[name](spark, FOLDER).toPandas()
    spark.catalog.clearCache()
    return out


def metrics_of(actual, predicted):
    error = actual - np.maximum(predicted, 0)
    return [np.abs(error).mean(), np.sqrt((error ** 2).mean()), np.abs(error / actual).mean() * 100]


def test_boosting_scores(spark):
    """All 200 rounds, from bins made with numpy; the rounds themselves are held against plain Python in test_trees."""
    got = run(spark, "boosting_scores").sort_values("window_id")
    rows, names = catalog._tree_rows(spark, FOLDER)
    data = rows.toPandas().sort_values("period")
    data = data.iloc[data["period"].astype(str).argsort(kind="stable")]
    x = np.stack([np.searchsorted(np.unique(data[f].astype(float)), data[f].astype(float)) for f in names], axis=1)
    fit = {**models.BOOSTING_DEFAULTS, "sets": [(models.BOOSTING_DEFAULTS["n_estimators"], "{}")]}
    for (_, r), w in zip(got.iterrows(), WINDOWS, strict=True):
        used = ((data["period"] <= w.train_end) | data["period"].between(w.val_start, w.val_end)).to_numpy()
        part = data[used]
        train = (part["period"] <= w.train_end).to_numpy()
        *_, last = trees.boosted_rounds(x[used], part["n"].to_numpy(dtype=float), part["period"].astype(str).tolist(), train, fit, 42,
                                        trees.MAX_BINS + 1)
        assert [r.MAE, r.RMSE, r.MAPE] == pytest.approx(metrics_of(part["n"].to_numpy()[~train], last[~train]), abs=1e-4)
    spark.catalog.clearCache()


def test_scores(spark, quick):
    got = run(spark, "forest_scores").sort_values("window_id")
    rows, names = catalog._tree_rows(spark, FOLDER)
    for (_, r), w in zip(got.iterrows(), WINDOWS, strict=True):
        fitted = models.fit_model(models.FOREST, rows.filter(F.col("period") <= w.train_end), names)
        held = fitted.transform(rows.filter(F.col("period").between(w.val_start, w.val_end))).toPandas()
        assert [r.MAE, r.RMSE, r.MAPE] == pytest.approx(metrics_of(held["n"], held["predicted"]), abs=1e-4)
    spark.catalog.clearCache()


def test_baselines(spark):
    assert difference(spark, connect(FOLDER), "baseline_tuning", FOLDER) == ""


def test_ablation_has_linear_figures(spark, quick):
    got = run(spark, "ablation_scores").set_index(["model", "feature_set"])
    rows = catalog.features.model_rows(catalog._orders_table(spark, FOLDER), ["trend"]).toPandas().sort_values("period")
    cuts = [(w.train_end, w.val_start, w.val_end) for w in WINDOWS] + [(VAL_END, VAL_END + 1, rows["period"].max())]
    want = []
    for end, first, last in cuts:
        train, held = rows[rows["period"] <= end], rows[rows["period"].between(first, last)]
        line = np.polyfit(train["trend"], train["n"], 1)
        want.append(metrics_of(held["n"].to_numpy(), np.polyval(line, held["trend"].to_numpy())))
    row = got.loc[models.LINEAR, "trend_only"]
    assert [row[f"average_rolling_{m}"] for m in ("MAE", "RMSE", "MAPE")] == pytest.approx(np.mean(want[:-1], axis=0), abs=1e-3)
    assert [row[f"test_{m}"] for m in ("MAE", "RMSE", "MAPE")] == pytest.approx(want[-1], abs=1e-3)
    assert len(got) == 8


def test_importances_and_forecast(spark, quick):
    ranks = run(spark, "importance_ranking")["importance"]
    assert len(ranks) == 4 and ranks.sum() == pytest.approx(1) and ranks.is_monotonic_decreasing
    steps = run(spark, "tree_forecast").sort_values("period")
    assert steps["lag_1"].tolist()[1:] == steps["predicted"].tolist()[:-1]


def test_recommendation_names_the_best(spark, quick):
    got = run(spark, "recommended_model").set_index("summary_type")["model"]
    rows, names = catalog._tree_rows(spark, FOLDER)
    averages = {m: np.mean([r.RMSE for r in backtest.rolling_backtest(m, rows, names, WINDOWS, clip=True).collect()])
                for m in models.MODEL_NAMES}
    spark.catalog.clearCache()
    assert got["selected_for_future_forecast"] == min(averages, key=averages.get)


def test_selected_future_holds_all_models_and_marks_one(spark, quick):
    got = run(spark, "selected_future")
    assert set(got["model"]) == set(models.MODEL_NAMES)
    assert (got.groupby("model")["period"].nunique() == catalog.HORIZON).all() and (got["predicted"] >= 0).all()
    advice = run(spark, "recommended_model").set_index("summary_type")["model"]
    assert set(got[got["selected"]]["model"]) == {advice["selected_for_future_forecast"]}
    steps = run(spark, "tree_forecast").sort_values("period")
    forest = got[got["model"] == models.FOREST].sort_values("period")
    assert forest["predicted"].tolist() == steps["predicted"].tolist()
    last = catalog._orders_table(spark, FOLDER).orderBy("period", ascending=False).first()
    assert set(got[got["model"] == models.NAIVE]["predicted"]) == {float(last["n"])}
    spark.catalog.clearCache()


@pytest.mark.parametrize("kind", ["numeric", "text"])
def test_clusters_and_profile(spark, quick, kind):
    clusters, profile = run(spark, f"{kind}_clusters"), run(spark, f"{kind}_cluster_profile")
    docs = catalog.document_features(spark, FOLDER).toPandas().merge(clusters, on="doc_id", validate="1:1")
    groups = docs.groupby(f"{kind}_cluster")
    assert len(docs) == spark.read.parquet(f"{FOLDER}/documents.parquet").count() and len(profile) == groups.ngroups
    for _, r in profile.iterrows():
        part = groups.get_group(r["cluster"])
        assert r["n"] == len(part) and r["share"] == pytest.approx(len(part) / len(docs), abs=1e-4)
        assert r["avg_len_words"] == pytest.approx(part["len_words"].mean(), abs=0.0051)
        flags = ["kw_number", "kw_acronym", "kw_address"][: 3 if kind == "numeric" else 2]
        assert r["dominant_flag"] == part[flags].mean().idxmax()
        assert kind == "numeric" or len(r["top_terms"].split(", ")) == 8


def test_kmeans_and_svd(spark, quick):
    got = run(spark, "kmeans_clusters")
    data = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas().merge(got, on="vec_id", validate="1:1")
    x = np.array(data["embedding"].tolist(), float)
    means = np.array([x[data["cluster"] == c].mean(axis=0) for c in range(10)])
    nearest = ((x[:, None] - means) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == data["cluster"]).mean() >= 0.99
    v = np.array([list(r) for r in run(spark, "svd_vectors")["reduced"]])
    energy = (v ** 2).sum(axis=0)
    assert v.shape[1] == 10 and (np.diff(energy) <= 1e-9).all()
