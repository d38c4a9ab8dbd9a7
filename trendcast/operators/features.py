"""Lag tables, feature lists and the leakage audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from trendcast.functions.labels import is_leakage_safe, leakage_reason
from trendcast.operators.cleaning import present
from trendcast.operators.reshape import densify as densify_series
from trendcast.operators.rollups import period_counts, period_rollup

# The feature set used for one segment's series.
SEGMENT_FEATURES = ("trend", "lag_1", "lag_2", "growth_rate_lag_1")


def series_window(keys: Sequence[str] = (), period: str = "period"):
    """Rows of one series in time order. A period table has at most one row per calendar period."""
    return Window.partitionBy(*keys).orderBy(period)


def growth_rate(
    period_df: DataFrame, keys: Sequence[str] = (), period: str = "period", target: str = "n"
) -> DataFrame:
    w = series_window(keys, period)
    previous = F.lag(target).over(w)
    return period_df.withColumn("growth_rate", F.try_divide(F.col(target) - previous, previous))


def lag_table(
    period_df: DataFrame,
    keys: Sequence[str] = (),
    period: str = "period",
    target: str = "n",
    shares: Sequence[str] = (),
    zero_growth: bool = False,
) -> DataFrame:
    """Add trend, lag_1, lag_2, growth_rate, growth_rate_lag_1 and the lag of every share.

    ``zero_growth`` turns an undefined growth rate into 0 before it is lagged,
    as the dense segment series need. Both window steps share one sort.
    """
    w = series_window(keys, period)
    growth = F.try_divide(F.col(target) - F.col("lag_1"), F.col("lag_1"))
    if zero_growth:
        growth = F.coalesce(growth, F.lit(0.0))
    return (
        period_df
        .withColumns({
            "trend": F.row_number().over(w),
            "lag_1": F.lag(target, 1).over(w),
            "lag_2": F.lag(target, 2).over(w),
        })
        .withColumn("growth_rate", growth)
        .withColumns({
            "growth_rate_lag_1": F.lag("growth_rate", 1).over(w),
            **{f"{s}_lag_1": F.lag(s, 1).over(w) for s in shares},
        })
    )


def modelling_table(
    df: DataFrame,
    flags: Sequence[str] = (),
    keys: Sequence[str] = (),
    period: str = "period",
    target: str = "n",
    densify: bool = False,
) -> DataFrame:
    """Events to the lag table: counts, flag sums and shares, trend, lags, growth, lagged shares.

    The trend numbers the periods that occur; ``densify`` first adds the empty
    ones, whose shares are unknown.
    """
    flags = present(df, flags)
    base = period_rollup(df.filter(F.col(period).isNotNull()), keys, period, flags=flags, target=target)
    if densify:
        spine = densify_series(base.select(*keys, period, target), keys, period, target)
        extra = base.drop(target)
        base = spine.join(extra, [*keys, period], "left").fillna(0, subset=list(flags) or None)
    return lag_table(base, keys, period, target, [f"{c}_share" for c in flags])


def segment_modelling_table(
    counts: DataFrame,
    keys: Sequence[str],
    period: str = "period",
    target: str = "n",
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Dense lag table for every segment series at once, undefined growth counted as 0."""
    dense = densify_series(counts, keys, period, target, start, end)
    return lag_table(dense, keys, period, target, zero_growth=True)


def segment_counts(df: DataFrame, segment: str, period: str = "period") -> DataFrame:
    """Events per (segment, period); rows without a segment are left out."""
    return period_counts(df.filter(F.col(segment).isNotNull()), [segment], period)


def last_values(
    period_df: DataFrame, keys: Sequence[str] = (), period: str = "period", target: str = "n",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Last and second-last target of each series, and the last known value of ``carry`` columns.

    ``max_by`` combines on the map side, so no series is sorted or gathered.
    """
    latest = F.max_by(F.struct(F.col(target).cast("double").alias("y"), F.col("lag_1").cast("double").alias("y1"),
                               F.col("growth_rate").alias("g")), period)
    known = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(period))).alias(c) for c in carry
    ]
    return (
        period_df.groupBy(*keys)
        .agg(F.max(period).alias("last_period"), F.max("trend").alias("last_trend"), latest.alias("__l"), *known)
        .select(*keys, "last_period", "last_trend", F.col("__l.y").alias("last_value"),
                F.col("__l.y1").alias("previous_value"), F.col("__l.g").alias("last_growth"), *carry)
    )


def default_features(columns: Sequence[str], flags: Sequence[str] = ()) -> list[str]:
    """The leakage-safe features a table has, in fixed order."""
    wanted = [*SEGMENT_FEATURES, *[f"{c}_share_lag_1" for c in flags]]
    have = set(columns)
    return [c for c in wanted if c in have]


def ablation_sets(columns: Sequence[str], flags: Sequence[str] = ()) -> list[dict]:
    """Four feature sets, each a superset of the one before."""
    have = set(columns)
    stages = [
        ("trend_only", "Trend only", ["trend"]),
        ("trend_plus_lags", "Trend plus lag_1 and lag_2", ["trend", "lag_1", "lag_2"]),
        ("trend_lags_growth", "Trend plus lag features and lagged growth", list(SEGMENT_FEATURES)),
        ("full_feature_set", "All lag-safe features, with lagged shares", default_features(columns, flags)),
    ]
    return [
        {"feature_set": name, "description": text, "features": [f for f in features if f in have]}
        for name, text, features in stages
    ]


def leakage_audit(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """Safety and reason per feature, with the number of rows of ``table`` that carry it."""
    counts = table.agg(*[F.count(f).alias(f"__n{i}") for i, f in enumerate(features)])
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"__n{i}").alias("n_known")) for i, f in enumerate(features)
    ])
    name = F.col("feature")
    return counts.select(F.inline(rows)).select(
        "feature", is_leakage_safe(name).alias("is_leakage_safe"), leakage_reason(name).alias("reason"), "n_known"
    )


def model_rows(
    table: DataFrame,
    features: Sequence[str],
    target: str = "n",
    keys: Sequence[str] = (),
    period: str = "period",
) -> DataFrame:
    """Keys, period, target and features; rows with a gap are dropped."""
    return table.select(*keys, period, target, *features).na.drop()
