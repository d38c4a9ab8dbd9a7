"""Recursive multi-step forecasts for every series of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from trendcast.operators.features import last_values
from trendcast.operators.metrics import clip_non_negative
from trendcast.operators.models import LinearModel, NaiveModel, TreeModel
from trendcast.operators.walk import compile_trees, tree_predictor, with_trees
from trendcast.session import cut_lineage

MODES = ("reference", "consistent")
PATH_FIELDS = ("trend", "lag_1", "lag_2", "growth_rate", "growth_rate_lag_1", "predicted")


def _carried(features: Sequence[str]) -> list[str]:
    """Share columns whose last known value stands in for every future lagged share."""
    return [f.removesuffix("_lag_1") for f in features if f.endswith("_share_lag_1")]


def forecast_start(
    table: DataFrame, features: Sequence[str] = (), keys: Sequence[str] = (), period: str = "period",
    target: str = "n",
) -> DataFrame:
    """What a forecast continues from: the tail of each series."""
    return last_values(table, keys, period, target, _carried(features))


def _growth(now: Column, before: Column, zero_growth: bool) -> tuple[Column, Column]:
    """Growth as stored in the row, and as a feature."""
    rate = F.try_divide(now - before, before)
    return rate, (F.coalesce(rate, F.lit(0.0)) if zero_growth else rate)


def fold_forecast(
    start: DataFrame,
    predict: Any,
    horizon: int,
    keys: Sequence[str] = (),
    period: str = "period",
    features: Sequence[str] = (),
    mode: str = "reference",
    zero_growth: bool = False,
    clip: bool = False,
) -> DataFrame:
    """Forecast by a fold over steps 1..horizon inside one row per series.

    ``predict`` maps feature columns to the predicted column, so this serves
    every model whose prediction is an expression. Nothing is shuffled: the
    state of a series (last two values, last growth) lives in the fold.

    In mode ``reference`` the lagged growth of a step is the growth stored with
    the previous row, which from step 2 on is one period older than in training.
    Mode ``consistent`` uses the training definition throughout.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {', '.join(MODES)}")
    fixed = {f"{s}_lag_1": F.col(s) for s in _carried(features)}
    cell = "struct<" + ",".join(f"{n}:double" for n in PATH_FIELDS) + ">"
    state = F.struct(
        F.col("last_value").alias("y1"), F.col("previous_value").alias("y2"),
        F.col("last_growth").cast("double").alias("g"), F.array().cast(f"array<{cell}>").alias("path"),
    )

    def step(acc: Column, s: Column) -> Column:
        rate, usable = _growth(acc["y1"], acc["y2"], zero_growth)
        lagged = usable if mode == "consistent" else acc["g"]
        if zero_growth:
            lagged = F.coalesce(lagged, F.lit(0.0))
        trend = (F.col("last_trend") + s).cast("double")
        values = {"trend": trend, "lag_1": acc["y1"], "lag_2": acc["y2"], "growth_rate_lag_1": lagged, **fixed}
        y = predict(values).cast("double")
        y = clip_non_negative(y) if clip else y
        row = F.struct(*[c.alias(n) for n, c in zip(PATH_FIELDS, (trend, acc["y1"], acc["y2"], rate, lagged, y))])
        return F.struct(
            y.alias("y1"), acc["y1"].alias("y2"), rate.alias("g"),
            F.concat(acc["path"], F.array(row)).cast(f"array<{cell}>").alias("path"),
        )

    # The outer explode keeps the optimizer from folding twice, once to test for emptiness.
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), state, step, lambda acc: acc["path"])
    carried = _carried(features)
    return start.withColumn("__path", path).select(
        *keys, *carried, "last_period", F.posexplode_outer("__path").alias("__step", "__row"),
    ).select(
        *keys, (F.col("last_period") + F.col("__step") + 1).cast("int").alias(period),
        *[F.col(f"__row.{n}").alias(n) for n in PATH_FIELDS[:-1]],
        *[F.col(s) for s in carried], *[F.col(s).alias(f"{s}_lag_1") for s in carried],
        F.col("__row.predicted").alias("predicted"),
    )


def coefficient_predictor(features: Sequence[str]):
    """Prediction from ``intercept`` and ``coef`` columns carried by each series' row."""
    def predict(values: Mapping[str, Column]) -> Column:
        total = F.col("intercept")
        for i, name in enumerate(features):
            total = total + F.get("coef", F.lit(i)) * values[name].cast("double")
        return total

    return predict


def forecast_linear(
    start: DataFrame, coefs: DataFrame, features: Sequence[str], horizon: int, keys: Sequence[str] = (), **options: Any
) -> DataFrame:
    """Linear forecasts for all series: join each tail with its coefficients, then fold."""
    if keys:
        both = start.join(coefs.select(*keys, "intercept", "coef"), list(keys))
    else:
        both = start.withColumns({c: coefs.select(c).scalar() for c in ("intercept", "coef")})
    return fold_forecast(both, coefficient_predictor(features), horizon, keys, features=features, **options)


def loop_forecast(
    start: DataFrame,
    model: Any,
    horizon: int,
    keys: Sequence[str] = (),
    period: str = "period",
    features: Sequence[str] = (),
    mode: str = "reference",
    zero_growth: bool = False,
    clip: bool = False,
    checkpoint_every: int = 8,
) -> DataFrame:
    """Forecast with a model that can only transform tables, one step of all series at a time.

    Each step appends to an array in the series' row, so the plan is one narrow
    chain; long horizons are cut into checkpointed pieces.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {', '.join(MODES)}")
    carried = _carried(features)
    state = start.withColumns({
        "y1": F.col("last_value"), "y2": F.col("previous_value"), "g": F.col("last_growth").cast("double"),
        **{f"{s}_lag_1": F.col(s) for s in carried},
    })
    base = [*keys, *carried, *[f"{s}_lag_1" for s in carried], "last_period", "last_trend"]
    done: list[str] = []
    for s in range(1, horizon + 1):
        rate, usable = _growth(F.col("y1"), F.col("y2"), zero_growth)
        lagged = usable if mode == "consistent" else F.col("g")
        if zero_growth:
            lagged = F.coalesce(lagged, F.lit(0.0))
        ready = state.withColumns({
            "trend": (F.col("last_trend") + s).cast("double"), "lag_1": F.col("y1"), "lag_2": F.col("y2"),
            "growth_rate": rate, "growth_rate_lag_1": lagged,
        })
        y = clip_non_negative(F.col("predicted")) if clip else F.col("predicted")
        scored = model.transform(ready).withColumn("predicted", y)
        row = f"__row{s}"
        state = scored.select(
            *base, *done, F.struct(*PATH_FIELDS).alias(row),
            F.col("predicted").alias("y1"), F.col("lag_1").alias("y2"), F.col("growth_rate").alias("g"),
        )
        done.append(row)
        if s % checkpoint_every == 0 and s < horizon:
            state = cut_lineage(state)
    return state.select(
        *keys, *carried, *[f"{s}_lag_1" for s in carried], "last_period",
        F.posexplode_outer(F.array(*done)).alias("__step", "__row"),
    ).select(
        *keys, (F.col("last_period") + F.col("__step") + 1).cast("int").alias(period),
        *[F.col(f"__row.{n}").alias(n) for n in PATH_FIELDS[:-1]],
        *carried, *[f"{s}_lag_1" for s in carried], F.col("__row.predicted").alias("predicted"),
    )


def forecast(start: DataFrame, model: Any, horizon: int, **options: Any) -> DataFrame:
    """Forecast with any fitted model: by a fold where its prediction is an expression, as it is for naive, linear and
    tree models, else step by step."""
    if isinstance(model, (NaiveModel, LinearModel)):
        return fold_forecast(start, model.predict, horizon, **options)
    if isinstance(model, TreeModel):
        trees = compile_trees(model)
        return fold_forecast(with_trees(start, trees), tree_predictor(trees, model.features), horizon, **options)
    return loop_forecast(start, model, horizon, **options)
