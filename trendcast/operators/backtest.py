"""Rolling-origin back-tests, tuning, ablation and fixed-window evaluation.

Naive and linear models score every series and window in one pass. Tree models
are one ``pyspark.ml`` fit per (window, parameters); the number of fits depends
on the caller's lists, never on the data. With series keys, a tree is fitted on
the rows of all series together and scored per series.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from trendcast.operators.features import model_rows
from trendcast.operators.metrics import METRICS, clip_non_negative, forecast_metrics, metric_columns, summarise_windows
from trendcast.operators.models import (
    BOOSTING, BOOSTING_DEFAULTS, FOREST, LINEAR, MODEL_NAMES, NAIVE, NaiveModel, check_model_name, coefficient_table,
    first_rounds, fit_model, importance_table,
)
from trendcast.operators.ols import fit_ols, ols_holdout
from trendcast.operators.splits import Window, window_array, window_rows

T = TypeVar("T")
R = TypeVar("R")
Params = Mapping[str, float]


def params_json(params: Params | None) -> str:
    return json.dumps(dict(params or {}), sort_keys=True)


def in_parallel(work: Callable[[T], R], items: Iterable[T], threads: int = 4) -> list[R]:
    """Run independent fits side by side; one small fit leaves most of a cluster idle."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(inherit(work), item) for item in items]]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _clipped(df: DataFrame, clip: bool) -> DataFrame:
    return df.withColumn("predicted", clip_non_negative(F.col("predicted"))) if clip else df


def _tree_predictions(
    name: str, rows: DataFrame, features: Sequence[str], windows: Sequence[Window], target: str, keys: Sequence[str],
    period: str, params: Params | None, seed: int, threads: int, fit: Callable[[int, DataFrame], Any] | None = None,
) -> DataFrame:
    p = F.col(period)
    fit = fit or (lambda _, train: fit_model(name, train, features, target, params, seed))

    def one(job: tuple[int, Window]) -> DataFrame | None:
        window_id, w = job
        train = rows.filter(p <= w.train_end)
        if train.isEmpty():
            return None
        model = fit(window_id, train)
        held = rows.filter(p.between(w.val_start, w.val_end))
        return model.transform(held).select(
            *keys, F.lit(window_id).alias("window_id"), period,
            F.col(target).cast("double").alias("actual"), "predicted",
        )

    frames = [f for f in in_parallel(one, enumerate(windows, start=1), threads) if f is not None]
    if not frames:
        raise ValueError("no window has training rows")
    return union_all(frames)


def window_sizes(
    rows: DataFrame, windows: Sequence[Window], keys: Sequence[str] = (), period: str = "period"
) -> DataFrame:
    """Bounds and row counts of each window per series; windows with an empty side are left out."""
    is_train = F.col("role") == "train"
    return (
        window_rows(rows.select(*keys, period), windows, period)
        .groupBy(*keys, "window_id", "train_end", "val_start", "val_end")
        .agg(
            F.min(F.when(is_train, F.col(period))).alias("train_start"),
            F.count_if(is_train).alias("n_train"),
            F.count_if(~is_train).alias("n_validation"),
        )
        .filter((F.col("n_train") > 0) & (F.col("n_validation") > 0))
    )


def rolling_backtest(
    name: str,
    rows: DataFrame,
    features: Sequence[str],
    windows: Sequence[Window],
    target: str = "n",
    keys: Sequence[str] = (),
    period: str = "period",
    params: Params | None = None,
    seed: int = 42,
    clip: bool = False,
    threads: int = 4,
    fit: Callable[[int, DataFrame], Any] | None = None,
) -> DataFrame:
    """One row per series and window: bounds, row counts, parameters and metrics rounded to 4 places.

    Windows with an empty side are left out. Naive and linear scores come from
    the pass that also counts the rows of each window. ``fit`` gives the tree
    model of a window from its number and training rows, if it is known already.
    """
    check_model_name(name)
    by = [*keys, "window_id"]
    tagged = window_rows(rows, windows, period)
    held = F.col("role") == "validation"
    if name == NAIVE:
        predicted = NaiveModel().predict({"lag_1": F.col("lag_1")})
        scored = tagged.withColumns({"actual": F.when(held, F.col(target).cast("double")), "predicted": predicted})
        counts = [F.min(F.when(~held, F.col(period))), F.count_if(~held), F.count_if(held)]
    elif name == LINEAR:
        scored = ols_holdout(tagged, features, target, by, period)
        counts = [F.min("train_start"), F.min("n_train"), F.count(F.lit(1))]
    else:
        predictions = _tree_predictions(name, rows, features, windows, target, keys, period, params, seed, threads, fit)
        scored = predictions.join(window_sizes(rows, windows, keys, period), by)
        counts = [F.min("train_start"), F.min("n_train"), F.count(F.lit(1))]
    scores = _clipped(scored, clip).groupBy(*by).agg(
        *[c.alias(n) for c, n in zip(counts, ("train_start", "n_train", "n_validation"))], *metric_columns())
    bounds = F.get(window_array(windows), F.col("window_id") - 1)
    return scores.filter((F.col("n_train") > 0) & (F.col("n_validation") > 0)).select(
        *keys, F.lit(name).alias("model"), "window_id", "train_start",
        *[bounds[c].alias(c) for c in ("train_end", "val_start", "val_end")],
        "n_train", "n_validation", F.lit(params_json(params)).alias("hyperparameters"), *METRICS,
    )


def tune(
    name: str,
    rows: DataFrame,
    features: Sequence[str],
    windows: Sequence[Window],
    grid: Sequence[Params],
    target: str = "n",
    period: str = "period",
    seed: int = 42,
    clip: bool = False,
    threads: int = 4,
) -> DataFrame:
    """Back-test every parameter set and rank the averages, best first.

    Boosted models that differ in the number of rounds only are scored from one fit of the most rounds.
    """
    def rest(params: Params) -> str:
        return params_json({k: v for k, v in params.items() if k != "n_estimators"})

    def rounds(params: Params) -> int:
        return int(params.get("n_estimators", BOOSTING_DEFAULTS["n_estimators"]))

    longest: dict[str, Params] = {}
    for params in sorted(grid, key=rounds) if name == BOOSTING else ():
        longest[rest(params)] = params
    jobs = [(key, i, w) for key in longest for i, w in enumerate(windows, start=1)]

    def boosted(job: tuple[str, int, Window]) -> Any:
        train = rows.filter(F.col(period) <= job[2].train_end)
        return None if train.isEmpty() else fit_model(name, train, features, target, longest[job[0]], seed)

    fitted = dict(zip([job[:2] for job in jobs], in_parallel(boosted, jobs, threads)))

    def one(params: Params) -> DataFrame:
        known = (lambda i, _: first_rounds(fitted[rest(params), i], rounds(params))) if fitted else None
        return rolling_backtest(
            name, rows, features, windows, target, (), period, params, seed, clip, threads=len(windows), fit=known)

    return summarise_windows(union_all(in_parallel(one, grid, threads)))


def best_parameters(tuning: DataFrame) -> dict[str, float]:
    """Parameters of the best row; an empty table gives an empty dict."""
    row = tuning.orderBy("average_RMSE", "average_MAE").select("hyperparameters").first()
    return {} if row is None else json.loads(row["hyperparameters"])


def tune_tree_models(
    rows: DataFrame,
    features: Sequence[str],
    windows: Sequence[Window],
    grids: Mapping[str, Sequence[Params]],
    **options: Any,
) -> tuple[dict[str, DataFrame], dict[str, dict[str, float]]]:
    """Tuning table and selected parameters for each model that has a grid."""
    tables = {name: tune(name, rows, features, windows, grid, **options) for name, grid in grids.items()}
    return tables, {name: best_parameters(table) for name, table in tables.items()}


def holdout_predictions(
    name: str,
    rows: DataFrame,
    features: Sequence[str],
    train_end: int,
    test_after: int,
    split: str,
    test_until: int | None = None,
    target: str = "n",
    keys: Sequence[str] = (),
    period: str = "period",
    params: Params | None = None,
    seed: int = 42,
    clip: bool = False,
) -> tuple[DataFrame, Any]:
    """Fit on periods ≤ ``train_end`` and predict those in (``test_after``, ``test_until``].

    Returns the predictions and, for models fitted on the driver's request, the model.
    """
    check_model_name(name)
    p = F.col(period)
    held = p > test_after if test_until is None else (p > test_after) & (p <= test_until)
    train = p <= train_end
    label = [F.lit(name).alias("model"), F.lit(split).alias("split")]
    if name == LINEAR:
        tagged = rows.filter(train | held).withColumn("role", F.when(train, "train").otherwise("held"))
        predicted = ols_holdout(tagged, features, target, keys, period)
        return _clipped(predicted, clip).select(*keys, *label, period, "actual", "predicted"), None
    model = fit_model(name, rows.filter(train), features, target, params, seed)
    predicted = model.transform(rows.filter(held)).withColumn("actual", F.col(target).cast("double"))
    return _clipped(predicted, clip).select(*keys, *label, period, "actual", "predicted"), model


def fixed_evaluation(
    rows: DataFrame,
    features: Sequence[str],
    models: Sequence[str],
    train_end: int,
    val_end: int,
    target: str = "n",
    keys: Sequence[str] = (),
    period: str = "period",
    params_by_model: Mapping[str, Params] | None = None,
    seed: int = 42,
    clip: bool = False,
    threads: int = 4,
) -> tuple[DataFrame, dict[str, Any]]:
    """Validation with a train-only fit, test with a refit on train + validation.

    Returns predictions (keys…, model, split, period, actual, predicted) and the
    fitted test models, which the interpretation tables are taken from.
    """
    params_by_model = params_by_model or {}
    jobs = [(m, split) for m in models for split in ("validation", "test")]

    def one(job: tuple[str, str]) -> tuple[DataFrame, Any]:
        name, split = job
        bounds = (train_end, train_end, split, val_end) if split == "validation" else (val_end, val_end, split, None)
        return holdout_predictions(
            name, rows, features, *bounds, target=target, keys=keys, period=period,
            params=params_by_model.get(name), seed=seed, clip=clip)

    results = in_parallel(one, jobs, threads)
    fitted = {name: model for (name, split), (_, model) in zip(jobs, results) if split == "test" and model is not None}
    return union_all([frame for frame, _ in results]), fitted


def interpretation_tables(
    rows: DataFrame,
    features: Sequence[str],
    fitted: Mapping[str, Any],
    val_end: int,
    target: str = "n",
    period: str = "period",
) -> dict[str, DataFrame]:
    """Coefficients of the linear model and importances of the trees, on train + validation rows."""
    spark = rows.sparkSession
    tables = {LINEAR: coefficient_table(fit_ols(rows.filter(F.col(period) <= val_end), features, target), features)}
    tables |= {name: importance_table(spark, m) for name, m in fitted.items() if hasattr(m, "model")}
    return tables


def ablation_table(
    table: DataFrame,
    feature_sets: Sequence[Mapping[str, Any]],
    windows: Sequence[Window],
    train_end: int,
    val_end: int,
    models: Sequence[str] = (LINEAR, FOREST),
    target: str = "n",
    period: str = "period",
    params_by_model: Mapping[str, Params] | None = None,
    seed: int = 42,
    clip: bool = False,
    threads: int = 4,
) -> DataFrame:
    """Rolling averages and hold-out test metrics for each feature set and model.

    Rows are dropped per feature set: a smaller set keeps the early periods whose
    lags are unknown.
    """
    params_by_model = params_by_model or {}
    jobs = [(s, m) for s in feature_sets for m in models]

    def one(job: tuple[Mapping[str, Any], str]) -> DataFrame:
        spec, name = job
        features, params = spec["features"], params_by_model.get(name)
        rows = model_rows(table, features, target, (), period)
        detailed = rolling_backtest(
            name, rows, features, windows, target, (), period, params, seed, clip, threads=len(windows))
        rolling = summarise_windows(detailed).select(
            *[F.col(f"average_{m}").alias(f"average_rolling_{m}") for m in METRICS])
        predictions, _ = holdout_predictions(
            name, rows, features, val_end, val_end, "test", target=target, period=period,
            params=params, seed=seed, clip=clip)
        test = predictions.agg(*[c.alias(f"test_{m}") for m, c in zip(METRICS, metric_columns())])
        label = {
            "model": name, "feature_set": spec["feature_set"], "description": spec["description"],
            "n_features": len(features),
        }
        tests = {f"test_{m}": test.select(f"test_{m}").scalar() for m in METRICS}
        return rolling.withColumns(tests).select(*[F.lit(v).alias(k) for k, v in label.items()], *rolling.columns, *tests)

    return union_all(in_parallel(one, jobs, threads)).orderBy("model", "average_rolling_RMSE", "test_RMSE")


def recommend(summary: DataFrame, metrics: DataFrame, params_by_model: Mapping[str, Params] | None = None,
              clip: bool = False) -> DataFrame:
    """The model with the best rolling average, and the one with the best hold-out test score."""
    chosen = params_by_model or {}
    text = F.lit(params_json(None))
    for name in MODEL_NAMES:
        text = F.when(F.col("model") == name, params_json(chosen.get(name))).otherwise(text)

    def row(table: DataFrame, kind: str, basis: str, prefix: str) -> DataFrame:
        values = [F.concat(F.lit(f"{prefix}{m}="), F.col(f"{prefix}{m}").cast("string")) for m in ("RMSE", "MAE", "MAPE")]
        best = table.orderBy(f"{prefix}RMSE", f"{prefix}MAE", "model").limit(1)
        return best.select(
            F.lit(kind).alias("summary_type"), "model", F.lit(basis).alias("selection_basis"),
            F.concat_ws(", ", *values).alias("selection_metrics"), text.alias("selected_hyperparameters"),
            F.lit(clip).alias("non_negative_constraint_applied"),
        )

    test = metrics.filter(F.col("split") == "test")
    return row(summary, "selected_for_future_forecast", "rolling_average_rmse", "average_") \
        .unionByName(row(test, "best_holdout_test_model", "holdout_test_rmse", ""))


def keep_models(table: DataFrame, names: Sequence[str]) -> DataFrame:
    return table.filter(F.col("model").isin(list(names)))
