"""Every operator as a query over the test tables: name → (spark, folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from trendcast.functions.periods import with_period
from trendcast.operators import (
    backtest, cleaning, features, metrics, models, ols, recursive, reshape, rollups, segment, segmented, spectrum, splits,
    stats, textvec, trees,
)
from trendcast.plans import flows
from trendcast.plans.bindings import (
    FLAGS, HORIZON, STOP_WORDS, TRAIN_END, TYPES, VAL_END, WINDOWS, document_features, hourly_events, nation_orders,
    order_events, raw_orders, table,
)
from trendcast.session import shared_folder
from trendcast.sources import handoff
from trendcast.sources.tables import parse_parameters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRIAL_GRID = splits.parameter_grid({"learning_rate": [0.01, 0.05, 0.1], "max_depth": [2, 3, 4]})
MEASURES = {"avg_len_words": ("len_words", 2)}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- cleaning -------------------------------------------------------------------------------------

@query
def clean_events(spark, d):
    return cleaning.clean_events(
        raw_orders(spark, d), ["kw_rush"], id_col="order_id", order_by=["seq"], date_cols=["order_date"])


@query
def dedup_first(spark, d):
    """First order of each customer."""
    return cleaning.keep_first(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query
def dedup_rows(spark, d):
    """Distinct (text, lang) of the documents: without the id column, equal rows collapse."""
    return cleaning.keep_first(table(spark, d, "documents").select("lang", "text"), "doc_id")


@query
def coerce_flags(spark, d):
    raw = cleaning.standardise_names(raw_orders(spark, d))
    return cleaning.coerce_flags(raw, ["kw_rush"]).select("seq", "kw_rush")


@query
def parse_dates(spark, d):
    raw = cleaning.standardise_names(raw_orders(spark, d))
    typed = cleaning.convert_types(raw, ["order_date"], "year")
    return typed.select("seq", "order_date", "year")


@query
def date_formats(spark, d):
    """Which format reads which of three date columns: day first, month first mixed with ISO, and text that is no date."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    texts = table(spark, d, "orders").select(
        F.when(k % 11 == 0, "not a date").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("day_first"),
        F.when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 5 == 0, " ")
        .otherwise(F.date_format(day, "MM/dd/yyyy")).alias("mixed"),
        F.col("o_orderpriority").alias("no_date"))
    return cleaning.date_format_tally(texts, ["day_first", "mixed", "no_date"], ["d/M/yyyy", "M/d/yyyy", "yyyy-MM-dd"])


@query
def published_cut(spark, d):
    """Orders handed over as a version by month; training reads the months up to the cut-off from it."""
    path = f"{shared_folder(spark)}/published_orders"
    orders = order_events(spark, d).select("period", "o_orderkey", "o_custkey", "o_totalprice")
    version = handoff.publish(orders, path)
    cut = handoff.read_version(spark, path, version).where(F.col("period") <= TRAIN_END)
    return cut.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_customers"),
        F.min("o_orderkey").alias("first_order"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def valid_period_filter(spark, d):
    raw = cleaning.standardise_names(raw_orders(spark, d))
    return cleaning.valid_periods(raw, "year").select("seq", "year")


@query
def null_profile(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return cleaning.null_profile(docs.join(labels, "doc_id", "left"))


@query
def fill_missing(spark, d):
    return cleaning.fill_missing(
        document_features(spark, d).select("doc_id", F.when(F.col("toxic") == 1, F.col("source")).alias("flagged_source"),
                                           "quality"),
        categories=["flagged_source"], numbers=["quality"])


@query
def parsed_parameters(spark, d):
    """JSON text of every event to a name → number map; unreadable text gives an empty map."""
    p = parse_parameters(F.col("props"))
    return table(spark, d, "events").select(
        "event_id", F.size(p).alias("n_params"), F.try_element_at(p, F.lit("k")).alias("k"))


# --- roll-ups -------------------------------------------------------------------------------------

@query
def period_counts(spark, d):
    return rollups.period_counts(hourly_events(spark, d))


@query
def flag_trends(spark, d):
    return rollups.flag_trends(order_events(spark, d), FLAGS)


@query
def flag_shares(spark, d):
    return rollups.flag_shares(order_events(spark, d), FLAGS)


@query
def type_trends(spark, d):
    return rollups.flag_trends(order_events(spark, d), TYPES)


@query
def type_shares(spark, d):
    return rollups.type_shares(order_events(spark, d), TYPES)


@query
def measure_means(spark, d):
    means = rollups.measure_means(order_events(spark, d), ["o_totalprice", "absent_measure"])
    return means.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query
def period_summary(spark, d):
    lines = _line_months(spark, d)
    return rollups.period_summary(lines, n_columns=len(lines.columns) - 1)


@query
def segment_trends(spark, d):
    return rollups.segment_trends(hourly_events(spark, d), "event_type")


@query
def segment_trends_topn(spark, d):
    """Line items per month and supplier, the five busiest suppliers by name, the rest as 'other'."""
    return rollups.segment_trends(_line_months(spark, d), "l_suppkey", top_n=5)


def _line_months(spark, d):
    return with_period(table(spark, d, "lineitem"), "l_shipdate", "month")


@query
def segment_shares(spark, d):
    trends = rollups.segment_trends(_line_months(spark, d), "l_returnflag")
    return rollups.segment_shares(trends, "l_returnflag")


@query
def segment_wide(spark, d):
    trends = rollups.segment_trends(_line_months(spark, d), "l_returnflag")
    return reshape.to_wide(trends, ["period"], "l_returnflag", "n", ["A", "N", "R"], prefix="n_")


@query
def segment_long(spark, d):
    """Flag shares as one row per period and flag, the form behind every multi-line chart."""
    return reshape.to_long(rollups.flag_shares(order_events(spark, d), FLAGS), ["period"], suffix="_share")


@query
def period_spine(spark, d):
    return reshape.densify(features.segment_counts(hourly_events(spark, d), "event_type"), ["event_type"])


# --- statistics -----------------------------------------------------------------------------------

@query
def flag_correlation(spark, d):
    r = stats.flag_correlation(order_events(spark, d), [*FLAGS, *TYPES])
    return r.withColumn("r", F.round("r", 6))


def _evidence(spark, d):
    base = rollups.period_rollup(order_events(spark, d), flags=FLAGS, types=TYPES, measures=["o_totalprice"])
    return stats.feature_evidence(base, [*[f"{c}_share" for c in (*FLAGS, *TYPES)], "o_totalprice"])


@query
def feature_evidence(spark, d):
    return _evidence(spark, d)


@query
def top_evidence(spark, d):
    return stats.top_evidence(_evidence(spark, d))


# --- lag tables -----------------------------------------------------------------------------------

def _orders_table(spark, d, keys=()):
    return features.modelling_table(order_events(spark, d), FLAGS, keys)


def _nation_counts(spark, d):
    return rollups.period_counts(nation_orders(spark, d), ["nation"])


def _nation_table(spark, d):
    """Dense lag table per nation. The zero-filled cells keep small scale factors complete."""
    return features.lag_table(reshape.densify(_nation_counts(spark, d), ["nation"]), ["nation"])


@query
def growth_rate(spark, d):
    counts = rollups.period_counts(order_events(spark, d))
    lags = features.lag_table(counts)
    return lags.select("period", "n", "trend", "lag_1", "lag_2", "growth_rate")


@query
def modelling_dataset(spark, d):
    return _orders_table(spark, d)


@query
def modelling_dataset_by_segment(spark, d):
    return _orders_table(spark, d, ["o_orderstatus"])


@query
def segment_modelling_dataset(spark, d):
    counts = features.segment_counts(hourly_events(spark, d), "event_type")
    return features.segment_modelling_table(counts, ["event_type"])


@query
def last_values(spark, d):
    return features.last_values(_nation_table(spark, d), ["nation"])


@query
def model_rows(spark, d):
    t = _orders_table(spark, d)
    return features.model_rows(t, features.default_features(t.columns, FLAGS))


@query
def leakage_audit(spark, d):
    t = _orders_table(spark, d)
    return features.leakage_audit(t, [*features.default_features(t.columns, FLAGS), "growth_rate"])


@query
def ablation_sets(spark, d):
    """Rows left per feature set: smaller sets keep the periods whose lags are unknown."""
    t = _orders_table(spark, d)
    return backtest.union_all([
        features.model_rows(t, s["features"]).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(s["feature_set"]).alias("feature_set"), F.lit(len(s["features"])).alias("n_features"), "n_rows")
        for s in features.ablation_sets(t.columns, FLAGS)
    ])


# --- splits, back-tests, metrics ------------------------------------------------------------------

def _nation_rows(spark, d):
    return features.model_rows(_nation_table(spark, d), ["trend", "lag_1", "lag_2"], keys=["nation"])


@query
def chrono_split(spark, d):
    rows = _nation_rows(spark, d)
    return splits.chrono_split(rows, TRAIN_END - 3, VAL_END, TRAIN_END + 1).select("nation", "period", "n", "split")


@query
def rolling_windows(spark, d):
    return backtest.window_sizes(_nation_rows(spark, d), WINDOWS, ["nation"])


@query
def trial_windows(spark, d):
    """Each parameter set of a grid with the windows it is tried on and their sizes."""
    sizes = backtest.window_sizes(features.model_rows(_orders_table(spark, d), ["lag_1"]), WINDOWS)
    trials = F.array(*[F.lit(backtest.params_json(p)) for p in TRIAL_GRID])
    return sizes.select("window_id", "n_train", "n_validation", F.explode(trials).alias("hyperparameters"))


@query
def naive_backtest(spark, d):
    return backtest.rolling_backtest(
        models.NAIVE, _nation_rows(spark, d), ["lag_1"], WINDOWS, keys=["nation"], clip=True)


@query
def rolling_summary(spark, d):
    detailed = backtest.rolling_backtest(models.NAIVE, _nation_rows(spark, d), ["lag_1"], WINDOWS, keys=["nation"])
    summary = metrics.summarise_windows(detailed, ["nation"])
    return summary.withColumns({c: F.round(c, 6) for c in summary.columns if c.startswith("average_")})


@query
def forecast_metrics(spark, d):
    """Naive errors by (nation, split), with zero actuals left out of the percentage."""
    rows = splits.chrono_split(_nation_rows(spark, d), TRAIN_END, VAL_END)
    return metrics.forecast_metrics(rows, ["nation", "split"], "n", "lag_1")


@query
def best_window(spark, d):
    """The (nation, window) with the smallest naive error."""
    detailed = backtest.rolling_backtest(models.NAIVE, _nation_rows(spark, d), ["lag_1"], WINDOWS, keys=["nation"])
    return metrics.best_row(detailed, "RMSE", "MAE", "nation", "window_id").select("nation", "window_id", "RMSE")


@query
def naive_future(spark, d):
    start = recursive.forecast_start(_nation_table(spark, d), keys=["nation"])
    return recursive.forecast(start, models.NaiveModel(), HORIZON, keys=["nation"])


@query
def trend_ols(spark, d):
    coefs = ols.fit_ols(_nation_table(spark, d), ["trend"], by=["nation"])
    out = models.coefficient_table(coefs, ["trend"], ["nation"])
    return out.withColumn("coefficient", F.round("coefficient", 6))


@query
def trend_ols_future(spark, d):
    t = _nation_table(spark, d)
    start = recursive.forecast_start(t, ["trend"], ["nation"])
    future = recursive.forecast_linear(start, ols.fit_ols(t, ["trend"], by=["nation"]), ["trend"], HORIZON, ["nation"],
                                       clip=True)
    return future.select("nation", "period", F.round("predicted", 4).alias("predicted"))


@query
def ar1_future(spark, d):
    t = _nation_table(spark, d)
    start = recursive.forecast_start(t, ["lag_1"], ["nation"])
    coefs = ols.fit_ols(features.model_rows(t, ["lag_1"], keys=["nation"]), ["lag_1"], by=["nation"])
    future = recursive.forecast_linear(start, coefs, ["lag_1"], HORIZON, ["nation"])
    return future.select("nation", "period", F.round("predicted", 4).alias("predicted"))


@query
def linear_backtest(spark, d):
    rows = _nation_rows(spark, d)
    return backtest.rolling_backtest(
        models.LINEAR, rows, ["trend", "lag_1", "lag_2"], WINDOWS, keys=["nation"], clip=True)


@query
def linear_coefficients(spark, d):
    """Coefficients on train + validation rows, one set per nation."""
    rows = _nation_rows(spark, d).filter(F.col("period") <= VAL_END)
    names = ["trend", "lag_1", "lag_2"]
    out = models.coefficient_table(ols.fit_ols(rows, names, by=["nation"]), names, ["nation"])
    return out.withColumn("coefficient", F.round("coefficient", 6))


# --- segmented forecasts --------------------------------------------------------------------------

def _segmented(spark, d, names):
    counts = _nation_counts(spark, d).withColumnRenamed("nation", "cluster")
    totals = rollups.period_counts(nation_orders(spark, d))
    return segmented.segmented_forecast(counts, totals, "by_nation", names, TRAIN_END, VAL_END, HORIZON, clip=True)


@query
def segmented_predictions(spark, d):
    return _segmented(spark, d, [models.NAIVE, models.LINEAR]).predictions


@query
def segmented_metrics(spark, d):
    return _segmented(spark, d, [models.NAIVE, models.LINEAR]).metrics.withColumn(
        "cluster", F.col("cluster").cast("string"))


@query
def segmented_future(spark, d):
    return _segmented(spark, d, [models.NAIVE, models.LINEAR]).future


def _total_rows(spark, d):
    totals = features.segment_modelling_table(rollups.period_counts(nation_orders(spark, d)), [])
    return totals, features.model_rows(totals, features.SEGMENT_FEATURES)


@query
def baseline_vs_segmented(spark, d):
    _, rows = _total_rows(spark, d)
    predictions, _ = backtest.fixed_evaluation(
        rows, features.SEGMENT_FEATURES, [models.LINEAR], TRAIN_END, VAL_END, clip=True)
    baseline = metrics.forecast_metrics(predictions, ["model", "split"])
    return segmented.baseline_vs_segmented(
        segmented.baseline_rows(baseline), _segmented(spark, d, [models.LINEAR]).metrics)


@query
def future_comparison(spark, d):
    t, rows = _total_rows(spark, d)
    start = recursive.forecast_start(t, features.SEGMENT_FEATURES)
    future = recursive.forecast_linear(
        start, ols.fit_ols(rows, features.SEGMENT_FEATURES), features.SEGMENT_FEATURES, HORIZON, zero_growth=True, clip=True)
    baseline = future.select(F.lit(models.LINEAR).alias("model"), "period", F.round("predicted", 4).alias("predicted"))
    return segmented.future_comparison(baseline, _segmented(spark, d, [models.LINEAR]).future)


@query
def total_future(spark, d):
    """Naive and linear models refitted on all months of the total and forecast."""
    t, rows = _total_rows(spark, d)
    plan = flows.ForecastPlan(horizon=HORIZON, model_names=(models.NAIVE, models.LINEAR))
    future = flows.future_forecasts(t, rows, features.SEGMENT_FEATURES, plan, "period", {}, zero_growth=True)
    return future.select("model", "period", F.round("predicted", 4).alias("predicted"))


# --- tree models ----------------------------------------------------------------------------------

def _with_sane_scores(table, *keys):
    """Bounds and counts of every window; of the scores, what holds for any forecast of positive numbers."""
    sane = (F.col("MAE") >= 0) & (F.col("MAE") <= F.col("RMSE") + 1e-4)
    return table.select(*keys, "model", "window_id", "train_start", "train_end", "val_start", "val_end", "n_train",
                        "n_validation", F.coalesce(sane, F.lit(False)).alias("scores_are_sane"))


def _tree_rows(spark, d):
    t = _orders_table(spark, d)
    names = list(features.SEGMENT_FEATURES)
    return features.model_rows(t, names).persist(), names


@query
def forest_scores(spark, d):
    rows, names = _tree_rows(spark, d)
    return backtest.rolling_backtest(models.FOREST, rows, names, WINDOWS, clip=True)


@query
def forest_backtest(spark, d):
    return _with_sane_scores(forest_scores(spark, d))


@query
def boosting_scores(spark, d):
    rows, names = _tree_rows(spark, d)
    return trees.backtest_grid(models.BOOSTING, rows, names, WINDOWS, [{}], clip=True)


@query
def boosting_backtest(spark, d):
    return _with_sane_scores(boosting_scores(spark, d))


@query
def pooled_forest_scores(spark, d):
    """One forest per window over the rows of all nations, scored per nation."""
    return backtest.rolling_backtest(
        models.FOREST, _nation_rows(spark, d).persist(), ["trend", "lag_1", "lag_2"], WINDOWS, keys=["nation"],
        clip=True)


@query
def pooled_forest_backtest(spark, d):
    return _with_sane_scores(pooled_forest_scores(spark, d), "nation")


@query
def tuning_table(spark, d):
    """The four parameter sets that the SQL lists; ``tree_tuning`` runs the whole grids."""
    rows, names = _tree_rows(spark, d)
    grid = splits.parameter_grid({"n_estimators": [5, 10], "max_depth": [3, 5], "min_samples_leaf": [1]})
    tuned = backtest.tune(models.FOREST, rows, names, WINDOWS, grid, clip=True)
    return tuned.select("model", "hyperparameters", (F.col("average_MAE") <= F.col("average_RMSE") + 1e-4).alias("scores_are_sane"))


def _baselines(rows, names):
    """Naive and linear rolling averages, the rows that every tuned model is held against."""
    return metrics.summarise_windows(backtest.union_all([
        backtest.rolling_backtest(m, rows, names, WINDOWS, clip=True) for m in (models.NAIVE, models.LINEAR)]))


@query
def baseline_tuning(spark, d):
    """The naive and linear rows of ``tree_tuning``."""
    out = _baselines(*_tree_rows(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("average_")})


@query
def tree_tuning(spark, d):
    """Both tree models over their whole grids, on all lag-safe features: rolling averages, and the selected parameters of
    each. Beside them the naive averages, and the linear ones on the four features of ``baseline_tuning``."""
    rows, names = _tree_rows(spark, d)
    t = _orders_table(spark, d)
    every = features.default_features(t.columns, FLAGS)
    grids = {models.FOREST: splits.parameter_grid(models.FOREST_GRID),
             models.BOOSTING: splits.parameter_grid(models.BOOSTING_GRID)}
    tables, best = trees.tune_jointly(features.model_rows(t, every), every, WINDOWS, grids, clip=True)
    best = [F.col("hyperparameters") == backtest.params_json(best[m]) for m in tables]
    tuned = [table.withColumn("selected", chosen) for table, chosen in zip(tables.values(), best)]
    return backtest.union_all([*tuned, _baselines(rows, names)])


def _rounded_nodes(nodes):
    return nodes.select("node", "feature", "threshold", "rows", F.round("gain", 4).alias("gain"), F.round("value", 6).alias("value"))


@query
def tree_nodes(spark, d):
    """The nodes of one tree of depth 2 on all months, without draws, each child of three months at least."""
    rows, names = _tree_rows(spark, d)
    return _rounded_nodes(trees.single_tree(rows, names, 2, min_leaf=3))


@query
def boosting_first_round(spark, d):
    """The stump that boosting grows first, without draws: leaves are shrunk by the penalty."""
    rows, names = _tree_rows(spark, d)
    return _rounded_nodes(trees.single_tree(rows, names, 1, l2=trees.LEAF_PENALTY, centred=True))


@query
def ablation_scores(spark, d):
    t = _orders_table(spark, d).persist()
    return backtest.ablation_table(t, features.ablation_sets(t.columns, FLAGS), WINDOWS, TRAIN_END, VAL_END, clip=True)


@query
def ablation_table(spark, d):
    table = ablation_scores(spark, d)
    sane = (F.col("average_rolling_MAE") <= F.col("average_rolling_RMSE") + 1e-4) & (
        F.col("test_MAE") <= F.col("test_RMSE") + 1e-4)
    return table.select("model", "feature_set", "n_features", sane.alias("scores_are_sane"))


@query
def importance_ranking(spark, d):
    rows, names = _tree_rows(spark, d)
    fitted = models.fit_model(models.FOREST, rows.filter(F.col("period") <= VAL_END), names)
    return models.importance_table(spark, fitted)


@query
def feature_importances(spark, d):
    table = importance_ranking(spark, d)
    total = table.agg(F.round(F.sum("importance"), 6)).scalar()
    return table.select("feature", (F.col("importance") >= 0).alias("not_negative"), total.alias("total"))


@query
def tree_forecast(spark, d):
    """Forest forecast step by step; each step feeds the next."""
    rows, names = _tree_rows(spark, d)
    start = recursive.forecast_start(_orders_table(spark, d), names)
    fitted = models.fit_model(models.FOREST, rows, names)
    return recursive.forecast(start, fitted, HORIZON, features=names, clip=True)


@query
def tree_future(spark, d):
    rows, _ = _tree_rows(spark, d)
    future = tree_forecast(spark, d)
    low, high = rows.agg(F.min("n")).scalar(), rows.agg(F.max("n")).scalar()
    return future.select("period", F.col("predicted").between(low, high).alias("within_training_range"))


@query
def recommended_model(spark, d):
    rows, names = _tree_rows(spark, d)
    used = models.MODEL_NAMES
    detailed = backtest.union_all([
        backtest.rolling_backtest(m, rows, names, WINDOWS, clip=True) for m in used])
    predictions, _ = backtest.fixed_evaluation(
        rows, names, used, TRAIN_END, VAL_END, clip=True)
    scores = metrics.forecast_metrics(predictions, ["model", "split"])
    return backtest.recommend(metrics.summarise_windows(detailed), scores, clip=True)


@query
def selected_future(spark, d):
    """All models refitted on all months and forecast; the recommended one is marked."""
    rows, names = _tree_rows(spark, d)
    future = flows.future_forecasts(
        _orders_table(spark, d), rows, names, flows.ForecastPlan(horizon=HORIZON), "period", {})
    return flows.mark_selected(future.select("model", "period", "predicted"), recommended_model(spark, d))


@query
def model_recommendation(spark, d):
    advice = recommended_model(spark, d)
    return advice.select("summary_type", "selection_basis", F.col("model").isin(*models.MODEL_NAMES).alias("names_a_candidate"))


@query
def segmented_forest_scores(spark, d):
    """Forests per order status, summed and scored."""
    counts = features.segment_counts(order_events(spark, d), "o_orderstatus").withColumnRenamed("o_orderstatus", "cluster")
    totals = rollups.period_counts(order_events(spark, d))
    return segmented.segmented_forecast(
        counts, totals, "by_status", [models.FOREST], TRAIN_END, VAL_END, HORIZON, clip=True).metrics


@query
def segmented_forest(spark, d):
    return segmented_forest_scores(spark, d).select(
        "scheme", "model", "split", "cluster", "n_clusters", (F.col("MAE") <= F.col("RMSE") + 1e-4).alias("scores_are_sane"))


@query
def training_cut(spark, d):
    """Events that training may see: rows of periods up to the cut-off."""
    events = order_events(spark, d)
    return events.filter(F.col("period") <= TRAIN_END).groupBy("period").agg(F.count(F.lit(1)).alias("n"))


# --- text vectors and segmentation ----------------------------------------------------------------

GRAMS = dict(terms="words", stop_words=STOP_WORDS, max_n=2)


def _words(spark, d):
    return textvec.add_words(table(spark, d, "documents").select("doc_id", "lang", "text"), "text")


@query
def term_statistics(spark, d):
    """The vocabulary: most frequent terms found in at least three documents."""
    return textvec.choose_vocabulary(textvec.frequent_statistics(_words(spark, d), [(3, 1000)], **GRAMS), 3, 1000)


@query
def tfidf_weights(spark, d):
    words = _words(spark, d)
    model = textvec.fit_tfidf(words, 3, 1000, **GRAMS)
    return textvec.part_entries(model.parts(words, "doc_id"), model, ["doc_id"]).withColumn("weight", F.round("weight", 6))


@query
def top_terms(spark, d):
    """Heaviest terms per language."""
    words = _words(spark, d)
    model = textvec.fit_tfidf(words, 3, 1000, **GRAMS)
    means = textvec.mean_weights(model.parts(words, "lang"), "lang", len(model.vocabulary))
    return means.select("lang", textvec.top_terms(array_to_vector("mean"), model).alias("top_terms"))


def _parts(spark, d, option):
    """TF-IDF vectors of the documents by an option of the grid, persisted, and the number of their columns."""
    words = _words(spark, d)
    model = textvec.fit_tfidf(words, option["min_df"], option["max_features"], **GRAMS)
    return model.parts(words, "doc_id").persist(), len(model.vocabulary)


def _svd(spark, d):
    parts, n_columns = _parts(spark, d, textvec.TEXT_GRID[-1])
    svd = textvec.svd_of_parts(parts, 10, n_columns)
    reduced = svd.transform(parts, parts=("indices", "values")).select("doc_id", "reduced").persist()
    reduced.count()
    parts.unpersist()
    return svd, reduced


@query
def svd_vectors(spark, d):
    return _svd(spark, d)[1]


@query
def svd_spectrum(spark, d):
    """The 100 largest singular values of the TF-IDF table, each with its residual and the scans that gave them."""
    option = textvec.TEXT_GRID[-1]
    parts, n_columns = _parts(spark, d, option)
    found = spectrum.truncated_svd(parts, option["svd_components"], n_columns)
    parts.unpersist()
    return spark.createDataFrame(
        [(i + 1, float(s), float(r), found.scans) for i, (s, r) in enumerate(zip(found.values, found.residuals))],
        "component int, singular_value double, residual double, scans int")


@query
def svd_projection(spark, d):
    svd, reduced = _svd(spark, d)
    # Projections are uncorrelated about zero, and no longer than the vectors, whose length is 1.
    cell = lambda i, j: F.sum(F.get("reduced", F.lit(i)) * F.get("reduced", F.lit(j)))
    cross = [F.abs(cell(i, j)) / F.sqrt(cell(i, i) * cell(j, j)) for i in range(10) for j in range(i)]
    norm = F.aggregate("reduced", F.lit(0.0), lambda a, x: a + x * x)
    return reduced.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("reduced")).alias("components"),
        (F.greatest(*cross) < 1e-6).alias("uncorrelated"), (F.max(norm) <= 1 + 1e-9).alias("no_longer_than_the_vectors"),
        F.lit(0.0 < svd.explained_variance < 1.0).alias("keeps_a_share"))


def _embeddings(spark, d):
    return table(spark, d, "embeddings")


@query
def silhouette_labels(spark, d):
    """Euclidean silhouette of the given labels over all rows."""
    scores = segment.silhouette_scores(_embeddings(spark, d), "embedding", ["label"])
    return scores.select(F.round("silhouette", 6).alias("silhouette"))


@query
def silhouette_squared(spark, d):
    return segment.silhouette_squared(_embeddings(spark, d), "embedding", "label").select(
        F.round("silhouette", 6).alias("silhouette"))


@query
def nearest_centroid(spark, d):
    e = _embeddings(spark, d)
    out = segment.nearest_centroid(e, "embedding", segment.centroids(e, "embedding", "label"), "label")
    return out.select("vec_id", "label", "nearest", F.round("squared_distance", 6).alias("squared_distance"))


@query
def scaled_features(spark, d):
    docs = document_features(spark, d)
    columns = ["len_chars", "len_words", "kw_number", "kw_acronym", "quality"]
    scaled = segment.fit_scaler(docs, columns).transform(docs)
    return scaled.select("doc_id", *[F.round(F.get("scaled", F.lit(i)), 6).alias(f"z_{c}") for i, c in enumerate(columns)])


@query
def segment_balance(spark, d):
    return segment.segment_balance(table(spark, d, "documents"), "lang", "by_lang")


@query
def smallest_segment(spark, d):
    docs = table(spark, d, "documents")
    both = segment.segment_balance(docs, "lang", "by_lang").unionByName(
        segment.segment_balance(docs, "source", "by_source"))
    return segment.smallest_segment(both)


@query
def segment_profile(spark, d):
    return segment.segment_profile(
        document_features(spark, d), "source", "doc_id",
        {"avg_len_words": ("len_words", 2), "avg_len_chars": ("len_chars", 2)},
        ["kw_number", "kw_acronym", "kw_address"], ["is_english", "is_other_lang"])


@query
def limitations(spark, d):
    docs = table(spark, d, "documents")
    score = segment.silhouette_squared(_embeddings(spark, d), "embedding", "label").select(
        F.lit(10).alias("k"), F.round("silhouette", 4).alias("silhouette_score"))
    smallest = segment.smallest_segment(segment.segment_balance(docs, "lang", "by_lang"))
    return segmented.limitations(
        rollups.period_counts(order_events(spark, d)), {"given_labels": score}, smallest, HORIZON)


def _whole(table):
    """What holds for clusters however they fall: sizes add up to all rows, shares to 1, none is empty."""
    return table.agg(F.sum("n").alias("n"), (F.abs(F.sum("share") - 1) < 0.001).alias("shares_add_up"),
                     (F.min("n") > 0).alias("none_empty"), F.count(F.lit(1)).between(2, 6).alias("k_in_grid"))


def _numeric(spark, d):
    docs = document_features(spark, d)
    half = F.col("doc_id") <= docs.agg(F.max("doc_id") / 2).scalar()
    return segment.numeric_segmentation(
        docs.filter(half), docs, ["len_chars", "len_words", "kw_number", "kw_acronym", "kw_address", "is_english"],
        "doc_id", period="doc_id", means=MEASURES,
        flags=["kw_number", "kw_acronym", "kw_address"], types=["is_english", "is_other_lang"])


@query
def numeric_segmentation(spark, d):
    """Documents clustered by measures of their text; fitted on the older half, applied to all."""
    return _whole(segment.segment_balance(_numeric(spark, d).assigned, "numeric_cluster", "numeric"))


@query
def numeric_clusters(spark, d):
    return _numeric(spark, d).assigned.select("doc_id", "numeric_cluster")


@query
def numeric_cluster_profile(spark, d):
    return _numeric(spark, d).profile


@query
def numeric_profile(spark, d):
    return _whole(_numeric(spark, d).profile)


def _text(spark, d, grid=textvec.TEXT_GRID):
    docs = document_features(spark, d)
    half = F.col("doc_id") <= docs.agg(F.max("doc_id") / 2).scalar()
    return segment.text_segmentation(
        docs.filter(half), docs, "text", "doc_id", grid, period="doc_id",
        means=MEASURES, flags=["kw_number", "kw_acronym"], types=["is_english", "is_other_lang"], stop_words=STOP_WORDS)


@query
def text_clusters(spark, d):
    return _text(spark, d).assigned.select("doc_id", "text_cluster")


@query
def text_cluster_profile(spark, d):
    return _text(spark, d).profile


@query
def text_segmentation(spark, d):
    return _whole(_text(spark, d).profile)


@query
def text_sensitivity(spark, d):
    """The two options that the SQL lists; ``text_options`` tries the whole grid."""
    grid = ({"min_df": 3, "max_features": 300, "svd_components": 10}, {"min_df": 5, "max_features": 500, "svd_components": 15})
    tried = _text(spark, d, grid).sensitivity
    return tried.select("min_df", "max_features", "svd_components", F.col("selected_k").between(2, 6).alias("k_in_grid"),
                        F.col("best_silhouette_score").between(-1, 1).alias("score_in_range"))


@query
def text_options(spark, d):
    """Chosen k, its silhouette and the explained variance for every option of the grid."""
    return _text(spark, d).sensitivity


@query
def k_scores(spark, d):
    """Silhouette per candidate k over the embeddings."""
    vectors = _embeddings(spark, d).select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return segment.choose_k(vectors, "v", k_values=(2, 3, 5, 10))


@query
def k_selection(spark, d):
    return k_scores(spark, d).select(
        "k", F.col("silhouette_score").between(-1, 1).alias("score_in_range"))


def _kmeans(spark, d):
    vectors = _embeddings(spark, d).select("vec_id", array_to_vector("embedding").alias("features")).persist()
    fitted = segment.fit_kmeans(vectors, 10, range(segment.RESTARTS))
    return fitted, vectors


@query
def kmeans_clusters(spark, d):
    """Embeddings assigned by the best of several KMeans starts."""
    fitted, vectors = _kmeans(spark, d)
    return fitted.transform(vectors).select("vec_id", "cluster")


@query
def kmeans_assignment(spark, d):
    fitted, vectors = _kmeans(spark, d)
    assigned = fitted.transform(vectors).select("vec_id", "cluster", vector_to_array("features").alias("v"))
    centres = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(fitted.clusterCenters())], "cluster int, centroid array<double>")
    nearest = segment.nearest_centroid(assigned, "v", centres, "cluster")
    return nearest.select("vec_id", (F.col("cluster") == F.col("nearest")).alias("at_nearest_centre"))
