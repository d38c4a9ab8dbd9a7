"""The three flows: profile an event table, forecast its total, segment and forecast.

The stages hand over through files in one output folder. Only the clean event
table is large; it is written once, partitioned by period, and every later scan
prunes by column and period. Everything after the first aggregate is as small as
the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendcast.functions.coerce import DAY_FIRST
from trendcast.operators import (
    backtest, cleaning, features, metrics, models, recursive, reshape, rollups, segment, segmented, splits, stats,
)
from trendcast.sources.tables import read_hyperparameters, write_events, write_table

Params = Mapping[str, float]


@dataclass(frozen=True)
class EventSpec:
    """Which columns of an event table play which role."""

    id_col: str
    period: str = "year"
    date_cols: Sequence[str] = ()
    flags: Sequence[str] = ()
    types: Sequence[str] = ()
    measures: Sequence[str] = ()
    segments: Sequence[str] = ()
    numbers: Sequence[str] = ()
    text: str | None = None
    order_by: Sequence[str] = ()
    date_formats: Sequence[str] = DAY_FIRST
    low: int = cleaning.MIN_YEAR
    high: int = cleaning.MAX_YEAR


@dataclass(frozen=True)
class ForecastPlan:
    """Windows, split, horizon and model choices. The defaults are the fixed values of the yearly study."""

    windows: Sequence[splits.Window] = (
        splits.Window(2000, 2001, 2005), splits.Window(2005, 2006, 2010), splits.Window(2010, 2011, 2016))
    train_end: int = 2010
    val_end: int = 2016
    horizon: int = 5
    model_names: Sequence[str] = models.MODEL_NAMES
    grids: Mapping[str, Sequence[Params]] = field(default_factory=lambda: {
        models.FOREST: splits.parameter_grid(models.FOREST_GRID),
        models.BOOSTING: splits.parameter_grid(models.BOOSTING_GRID),
    })
    segment_models: Sequence[str] = (models.LINEAR, models.FOREST)
    k_values: Sequence[int] = segment.K_VALUES
    restarts: int = segment.RESTARTS
    text_grid: Sequence[Mapping[str, int]] = segment.TEXT_GRID
    stop_words: Sequence[str] | None = None
    tree_fit: str = "per_segment"
    mode: str = "reference"
    clip: bool = True
    seed: int = 42


def _save(tables: Mapping[str, DataFrame], out: str, spark: SparkSession) -> dict[str, DataFrame]:
    """Write each report table and hand back the written copies."""
    for name, df in tables.items():
        write_table(df, f"{out}/{name}", single_file=True)
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}


def clean_path(out: str) -> str:
    return f"{out}/clean_events"


def run_profile(raw: DataFrame, spec: EventSpec, out: str) -> dict[str, DataFrame]:
    """Null profile, clean table and the period roll-ups."""
    spark, p = raw.sparkSession, spec.period
    clean = cleaning.clean_events(
        raw, [*spec.flags, *spec.types], spec.id_col, spec.order_by, spec.date_cols, p, spec.date_formats,
        spec.low, spec.high)
    write_events(clean, clean_path(out), p)
    events = spark.read.parquet(clean_path(out))
    wide = rollups.period_rollup(events, (), p, spec.flags, spec.types, spec.measures).persist()
    flags, types, measures = (cleaning.present(events, c) for c in (spec.flags, spec.types, spec.measures))
    flag_shares, type_shares = [f"{c}_share" for c in flags], [f"{c}_share" for c in types]
    tables = {
        "missing_values": cleaning.null_profile(raw),
        "period_counts": wide.select(p, "n"),
        "flag_trends": wide.select(p, *flags),
        "flag_shares": wide.select(p, *flag_shares),
        "type_trends": wide.select(p, *types),
        "type_shares": wide.select(p, *type_shares),
        "measure_means": wide.select(p, *measures),
        "growth_rate": features.growth_rate(wide.select(p, "n"), (), p),
        "feature_evidence": stats.feature_evidence(wide, [*flag_shares, *type_shares, *measures]),
        "period_summary": rollups.period_summary(events, p),
    }
    if len(flags) > 1:
        tables["flag_correlation"] = stats.flag_correlation(events, flags)
    for column in cleaning.present(events, spec.segments):
        trends = rollups.segment_trends(events, column, period=p).persist()
        tables[f"{column}_trends"] = trends
        tables[f"{column}_shares"] = rollups.segment_shares(trends, column, period=p)
    saved = _save({n: (t.orderBy(p) if p in t.columns else t) for n, t in tables.items()}, out, spark)
    for cached in (wide, *[tables[f"{c}_trends"] for c in cleaning.present(events, spec.segments)]):
        cached.unpersist()
    return saved | {"clean_events": events}


def run_forecast(spark: SparkSession, spec: EventSpec, plan: ForecastPlan, out: str) -> dict[str, DataFrame]:
    """Lag table, audit, tuning, back-tests, ablation, fixed evaluation and forecasts of the total."""
    p = spec.period
    events = spark.read.parquet(clean_path(out))
    flags = cleaning.present(events, spec.flags)
    table = features.modelling_table(events, flags, (), p).persist()
    names = features.default_features(table.columns, flags)
    rows = features.model_rows(table, names, "n", (), p).persist()
    common = dict(period=p, seed=plan.seed, clip=plan.clip)

    grids = {m: g for m, g in plan.grids.items() if m in plan.model_names and g}
    tuning, params = backtest.tune_tree_models(rows, names, plan.windows, grids, **common)
    detailed = backtest.union_all([
        backtest.rolling_backtest(m, rows, names, plan.windows, params=params.get(m), **common) for m in plan.model_names])
    detailed = _save({"rolling_detailed": detailed}, out, spark)["rolling_detailed"]
    summary = metrics.summarise_windows(detailed)
    predictions, fitted = backtest.fixed_evaluation(
        rows, names, plan.model_names, plan.train_end, plan.val_end, params_by_model=params, **common)
    scores = metrics.forecast_metrics(predictions, ["model", "split"])
    future = future_forecasts(table, rows, names, plan, p, params)
    best = metrics.best_row(summary, "average_RMSE", "average_MAE", "model").select("model").first()["model"]
    ablation_models = [m for m in (models.LINEAR, models.FOREST) if m in plan.model_names]
    tables = {
        "modelling_table": table,
        "model_rows": rows,
        "leakage_audit": features.leakage_audit(table, names),
        "rolling_summary": summary,
        "selected_hyperparameters": spark.createDataFrame(
            [(m, backtest.params_json(params.get(m))) for m in plan.model_names], "model string, selected_hyperparameters string"),
        "ablation": backtest.ablation_table(
            table, features.ablation_sets(table.columns, flags), plan.windows, plan.train_end, plan.val_end,
            ablation_models, params_by_model=params, **common),
        "model_metrics": scores,
        "tree_comparison": backtest.keep_models(scores, models.TREE_MODELS),
        "test_predictions": predictions.filter(F.col("split") == "test"),
        "future": future,
        "selected_future": future.filter(F.col("model") == best).withColumn("selected_model", F.col("model")),
        "recommendation": backtest.recommend(summary, scores, params, plan.clip),
    }
    tables |= {f"tuning_{_slug(m)}": t for m, t in tuning.items()}
    tables |= {
        f"interpretation_{_slug(m)}": t
        for m, t in backtest.interpretation_tables(rows, names, fitted, plan.val_end, period=p).items() if m in plan.model_names
    }
    saved = _save(tables, out, spark)
    rows.unpersist()
    table.unpersist()
    return saved | {"rolling_detailed": detailed}


def future_forecasts(
    table: DataFrame, rows: DataFrame, names: Sequence[str], plan: ForecastPlan, period: str,
    params: Mapping[str, Params], zero_growth: bool = False,
) -> DataFrame:
    """Refit each model on all rows and forecast; one table with a ``model`` column."""
    start = recursive.forecast_start(table, names, (), period)

    def one(name: str) -> DataFrame:
        fitted = models.fit_model(name, rows, names, params=params.get(name), seed=plan.seed)
        steps = recursive.forecast(
            start, fitted, plan.horizon, period=period, features=names, mode=plan.mode, clip=plan.clip,
            zero_growth=zero_growth)
        return steps.withColumn("model", F.lit(name))

    return backtest.union_all(backtest.in_parallel(one, plan.model_names))


def mark_selected(future: DataFrame, advice: DataFrame) -> DataFrame:
    """``future`` with a column ``selected``: whether ``advice`` (of :func:`backtest.recommend`) forecasts with that model."""
    chosen = advice.where("summary_type = 'selected_for_future_forecast'").select("model").scalar()
    return future.withColumn("selected", F.col("model") == chosen)


def _slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def run_segments(spark: SparkSession, spec: EventSpec, plan: ForecastPlan, out: str) -> dict[str, DataFrame]:
    """Cluster the events by text and by numbers, forecast each cluster, compare with the total."""
    p = spec.period
    events = spark.read.parquet(clean_path(out))
    totals = rollups.period_counts(events, (), p).persist()
    first, last = totals.agg(F.min(p), F.max(p)).first()
    train = events.filter(F.col(p) <= plan.train_end)
    params = read_hyperparameters(spark, f"{out}/selected_hyperparameters")
    means = {f"avg_{c}": (c, 2) for c in cleaning.present(events, spec.measures)}
    shared = dict(k_values=plan.k_values, restarts=plan.restarts, seed=plan.seed, period=p, means=means,
                  flags=spec.flags, types=spec.types)
    schemes: dict[str, tuple[segment.Segmentation, str]] = {}
    if spec.text:
        schemes["text_kmeans"] = segment.text_segmentation(
            train, events, spec.text, spec.id_col, plan.text_grid, stop_words=plan.stop_words, **shared), "text_cluster"
    numbers = cleaning.present(events, spec.numbers)
    if numbers:
        schemes["numeric_kmeans"] = segment.numeric_segmentation(
            train, events, numbers, spec.id_col, **shared), "numeric_cluster"

    saved: dict[str, DataFrame] = {}
    balances, forecasts, selections = [], [], {}
    for scheme, (result, column) in schemes.items():
        counts = features.segment_counts(result.assigned, column, p).withColumn(
            column, F.concat(F.lit("cluster_"), column)).withColumnRenamed(column, "cluster")
        tables = {f"{scheme}_selection": result.selection, f"{scheme}_profile": result.profile}
        if result.sensitivity is not None:
            tables[f"{scheme}_sensitivity"] = result.sensitivity
        # Assigning all events is the expensive step: its counts are written once and reused.
        tables[f"{scheme}_counts"] = reshape.densify(counts.persist(), ["cluster"], p, start=first, end=last)
        saved |= _save(tables, out, spark)
        counts.unpersist()
        dense = saved[f"{scheme}_counts"]
        balances.append(_balance(dense, scheme))
        selections[scheme] = saved[f"{scheme}_selection"]
        forecasts.append(segmented.segmented_forecast(
            dense, totals, scheme, plan.segment_models, plan.train_end, plan.val_end, plan.horizon, period=p,
            start=first, end=last, mode=plan.mode, clip=plan.clip, seed=plan.seed, params_by_model=params,
            tree_fit=plan.tree_fit))
    balance = backtest.union_all(balances)
    reports = _save({
        "cluster_balance": balance,
        "segmented_metrics": backtest.union_all([f.metrics for f in forecasts]),
        "segmented_predictions": backtest.union_all([f.predictions for f in forecasts]),
        "segmented_future": backtest.union_all([f.future for f in forecasts]),
        "limitations": segmented.limitations(totals, selections, segment.smallest_segment(balance), plan.horizon),
    }, out, spark)
    for f in forecasts:
        f.release()
    baseline = segmented.baseline_rows(spark.read.parquet(f"{out}/model_metrics"), plan.segment_models)
    future = spark.read.parquet(f"{out}/future").select("model", p, "predicted")
    comparisons = _save({
        "baseline_vs_segmented": segmented.baseline_vs_segmented(baseline, reports["segmented_metrics"]),
        "future_comparison": segmented.future_comparison(
            future, reports["segmented_future"], plan.segment_models, p),
    }, out, spark)
    totals.unpersist()
    return saved | reports | comparisons


def _balance(counts: DataFrame, scheme: str) -> DataFrame:
    """Cluster sizes from the written counts, without another pass over the events."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.groupBy("cluster").agg(F.sum("n").alias("n")).select(
        F.lit(scheme).alias("scheme"), "cluster", "n", F.round(F.col("n") / total, 4).alias("share"))
