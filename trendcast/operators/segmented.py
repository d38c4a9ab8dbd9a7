"""Forecast every segment, add the segments up and compare with the unsegmented forecast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from trendcast.operators.backtest import in_parallel, union_all
from trendcast.operators.features import SEGMENT_FEATURES, model_rows, segment_modelling_table
from trendcast.operators.metrics import METRICS, clip_non_negative, forecast_metrics
from trendcast.operators.models import FOREST, LINEAR, NAIVE, NaiveModel, check_model_name, fit_model
from trendcast.operators.ols import fit_ols, ols_holdout
from trendcast.operators.recursive import fold_forecast, forecast, forecast_linear, forecast_start

TOTAL_LABEL = "aggregated_total"
TREE_FITS = ("per_segment", "pooled")


class SegmentedForecast(NamedTuple):
    """Metrics (totals, then clusters), summed predictions, and futures per cluster and in total.

    The lag table and the held-out predictions behind them stay cached until ``release``.
    """

    metrics: DataFrame
    predictions: DataFrame
    future: DataFrame
    cached: tuple[DataFrame, ...]

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()


class _Fit(NamedTuple):
    held: DataFrame
    future: DataFrame


def _tagged(rows: DataFrame, train_end: int, val_end: int, period: str) -> DataFrame:
    """Each row once per split it serves: validation (fit ≤ train_end) and test (fit ≤ val_end)."""
    p = F.col(period)
    uses = F.array_compact(F.array(
        F.when(p <= val_end, F.struct(F.lit("validation").alias("split"),
                                      F.when(p <= train_end, "train").otherwise("held").alias("role"))),
        F.struct(F.lit("test").alias("split"), F.when(p <= val_end, "train").otherwise("held").alias("role")),
    ))
    return rows.select("*", F.inline(uses))


def _clip(df: DataFrame, clip: bool) -> DataFrame:
    return df.withColumn("predicted", clip_non_negative(F.col("predicted"))) if clip else df


def _expression_fit(
    name: str, table: DataFrame, rows: DataFrame, keys: list[str], bounds: tuple[int, int], horizon: int,
    period: str, target: str, mode: str, clip: bool,
) -> _Fit:
    """Naive and linear: all segments and scopes in one grouped pass, futures by a fold."""
    tagged = _tagged(rows, *bounds, period)
    start = forecast_start(table, SEGMENT_FEATURES, keys, period, target)
    options = dict(period=period, mode=mode, zero_growth=True, clip=clip)
    if name == LINEAR:
        held = ols_holdout(tagged, SEGMENT_FEATURES, target, [*keys, "split"], period).drop("train_start", "n_train")
        coefs = fit_ols(rows, SEGMENT_FEATURES, target, keys)
        future = forecast_linear(start, coefs, SEGMENT_FEATURES, horizon, keys, **options)
    else:
        model = NaiveModel()
        held = model.transform(tagged.filter(F.col("role") == "held")).select(
            *keys, "split", period, F.col(target).cast("double").alias("actual"), "predicted")
        future = fold_forecast(start, model.predict, horizon, keys, features=SEGMENT_FEATURES, **options)
    return _Fit(_clip(held, clip), future.select(*keys, period, "predicted"))


def _tree_fit(
    name: str, table: DataFrame, rows: DataFrame, keys: list[str], bounds: tuple[int, int], horizon: int,
    period: str, target: str, mode: str, clip: bool, params: Mapping[str, float] | None, seed: int,
    tree_fit: str, threads: int,
) -> _Fit:
    """Trees: three fits per segment, or three fits over the rows of all segments when pooled."""
    p = F.col(period)
    train_end, val_end = bounds
    start = forecast_start(table, SEGMENT_FEATURES, keys, period, target)
    if tree_fit == "pooled":
        scopes = [None]
    else:
        scopes = [tuple(r) for r in start.select(*keys).toLocalIterator()]

    def only(df: DataFrame, scope: tuple | None) -> DataFrame:
        for key, value in zip(keys, scope or ()):
            df = df.filter(F.col(key).eqNullSafe(F.lit(value)))
        return df

    def one(job: tuple[tuple | None, str]) -> DataFrame:
        scope, split = job
        mine = only(rows, scope)
        if split == "future":
            model = fit_model(name, mine, SEGMENT_FEATURES, target, params, seed)
            steps = forecast(only(start, scope), model, horizon, keys=keys, period=period, features=SEGMENT_FEATURES,
                             mode=mode, zero_growth=True, clip=clip)
            return steps.select(*keys, period, "predicted")
        last, held = (train_end, p.between(train_end + 1, val_end)) if split == "validation" else (val_end, p > val_end)
        model = fit_model(name, mine.filter(p <= last), SEGMENT_FEATURES, target, params, seed)
        return model.transform(mine.filter(held)).select(
            *keys, F.lit(split).alias("split"), period, F.col(target).cast("double").alias("actual"), "predicted")

    jobs = [(scope, split) for scope in scopes for split in ("validation", "test", "future")]
    frames = in_parallel(one, jobs, threads)
    held = union_all([f for f, (_, split) in zip(frames, jobs) if split != "future"])
    future = union_all([f for f, (_, split) in zip(frames, jobs) if split == "future"])
    return _Fit(_clip(held, clip), future)


def segmented_forecast(
    counts: DataFrame,
    totals: DataFrame,
    scheme: str,
    models: Sequence[str],
    train_end: int,
    val_end: int,
    horizon: int,
    segment: str = "cluster",
    period: str = "period",
    target: str = "n",
    start: int | None = None,
    end: int | None = None,
    mode: str = "reference",
    clip: bool = False,
    seed: int = 42,
    params_by_model: Mapping[str, Mapping[str, float]] | None = None,
    tree_fit: str = "per_segment",
    threads: int = 4,
) -> SegmentedForecast:
    """Back-test and forecast each segment's series and their sum.

    ``counts`` is long (segment, period, n); empty cells are filled in here.
    Segments are added per period by key, unrounded and after clipping, and the
    sum is scored against ``totals``. ``tree_fit='pooled'`` fits one tree model
    for all segments, for when there are too many for a fit each.
    """
    if tree_fit not in TREE_FITS:
        raise ValueError(f"unknown tree_fit {tree_fit!r}; use one of {', '.join(TREE_FITS)}")
    params_by_model = params_by_model or {}
    table = segment_modelling_table(counts, [segment], period, target, start, end).persist()
    rows = model_rows(table, SEGMENT_FEATURES, target, [segment], period)
    helds, futures = [], []
    for name in models:
        check_model_name(name)
        args = (name, table, rows, [segment], (train_end, val_end), horizon, period, target, mode, clip)
        if name in (NAIVE, LINEAR):
            fit = _expression_fit(*args)
        else:
            fit = _tree_fit(*args, params_by_model.get(name), seed, tree_fit, threads)
        helds.append(fit.held.withColumn("model", F.lit(name)))
        futures.append(fit.future.withColumn("model", F.lit(name)))
    held, future = union_all(helds).persist(), union_all(futures)
    scheme_col = F.lit(scheme).alias("scheme")

    summed = held.groupBy("model", "split", period).agg(F.sum("predicted").alias("predicted"))
    actual = totals.select(period, F.col(target).cast("double").alias("actual"))
    predictions = summed.join(actual, period, "left").select(
        scheme_col, "model", "split", period, "actual", "predicted")
    n_segments = table.agg(F.count_distinct(segment).cast("int")).scalar()
    total_metrics = forecast_metrics(predictions, ["scheme", "model", "split"]).withColumn("n_clusters", n_segments)
    segment_metrics = forecast_metrics(held, [segment, "model", "split"]).select(
        scheme_col, F.col(segment).alias("cluster"), "model", "split", *METRICS)
    metrics = total_metrics.unionByName(segment_metrics, allowMissingColumns=True)

    # Each forecast counts once for its segment and once for the total, in one aggregate.
    labels = F.explode(F.array(F.col(segment).cast("string"), F.lit(TOTAL_LABEL))).alias("cluster")
    all_futures = future.select("model", labels, period, "predicted").groupBy("model", "cluster", period).agg(
        F.round(F.sum("predicted"), 4).alias("predicted")).select(scheme_col, "model", "cluster", period, "predicted")
    return SegmentedForecast(
        metrics, predictions.withColumn("predicted", F.round("predicted", 4)), all_futures, (table, held))


def baseline_rows(metrics: DataFrame, models: Sequence[str] = (LINEAR, FOREST)) -> DataFrame:
    """Unsegmented metrics in the shape of segmented ones."""
    return metrics.filter(F.col("model").isin(list(models))).select(
        F.lit("no_segmentation").alias("scheme"), "model", "split", *METRICS, F.lit(1).alias("n_clusters"))


def baseline_vs_segmented(baseline: DataFrame, segmented: DataFrame) -> DataFrame:
    """Unsegmented next to summed-segment metrics, best RMSE of each split first."""
    totals = segmented.filter(F.col("cluster").isNull()).select(
        "scheme", "model", "split", *METRICS, "n_clusters")
    return baseline.unionByName(totals).orderBy("split", "RMSE", "scheme", "model")


def future_comparison(
    baseline: DataFrame, segmented: DataFrame, models: Sequence[str] = (LINEAR, FOREST), period: str = "period"
) -> DataFrame:
    """Unsegmented next to summed-segment forecasts. ``baseline`` has (model, period, predicted)."""
    base = baseline.filter(F.col("model").isin(list(models))).select(
        F.lit("no_segmentation").alias("scheme"), "model", period, F.col("predicted").alias("predicted_total"))
    totals = segmented.filter(F.col("cluster") == TOTAL_LABEL).select(
        "scheme", "model", period, F.col("predicted").alias("predicted_total"))
    return base.unionByName(totals).orderBy(period, "scheme", "model")


def limitations(
    totals: DataFrame, selections: Mapping[str, DataFrame], smallest: DataFrame, horizon: int
) -> DataFrame:
    """Evidence rows (theme, evidence): history length, horizon, separation and balance of the clusters."""
    rows = [
        totals.agg(F.format_string("%d periods available", F.count(F.lit(1))).alias("evidence"))
        .select(F.lit("sample_size").alias("theme"), "evidence"),
        totals.agg(F.format_string("horizon of %d periods", F.max(F.lit(horizon))).alias("evidence"))
        .select(F.lit("recursive_forecasting").alias("theme"), "evidence"),
    ]
    for scheme, selection in selections.items():
        rows.append(selection.agg(F.format_string("best silhouette %.4f", F.max("silhouette_score")).alias("evidence"))
                    .select(F.lit(f"{scheme}_separation").alias("theme"), "evidence"))
    each = F.format_string("%s: %s %.4f", "scheme", F.col("cluster").cast("string"), "share")
    rows.append(smallest.agg(F.array_join(F.array_sort(F.collect_list(each)), "; ").alias("evidence"))
                .select(F.lit("cluster_imbalance").alias("theme"), "evidence"))
    return union_all(rows)
