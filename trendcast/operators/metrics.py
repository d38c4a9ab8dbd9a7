"""Forecast errors and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

METRICS = ("MAE", "RMSE", "MAPE")


def metric_columns(actual: str = "actual", predicted: str = "predicted", digits: int | None = 4) -> list[Column]:
    """MAE, RMSE and MAPE (in %, periods with an actual of 0 skipped) as aggregates."""
    y = F.col(actual).cast("double")
    error = y - F.col(predicted)
    columns = [
        F.avg(F.abs(error)),
        F.sqrt(F.avg(error * error)),
        F.avg(F.abs(F.try_divide(error, y))) * 100,
    ]
    return [(F.round(c, digits) if digits is not None else c).alias(n) for c, n in zip(columns, METRICS)]


def forecast_metrics(
    predictions: DataFrame, by: Sequence[str], actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    return predictions.groupBy(*by).agg(*metric_columns(actual, predicted))


def clip_non_negative(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))


def summarise_windows(detailed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over windows of the already rounded window metrics, best first."""
    means = [F.avg(m).alias(f"average_{m}") for m in METRICS]
    return (
        detailed.groupBy(*keys, "model", "hyperparameters").agg(*means)
        .orderBy(*keys, "average_RMSE", "average_MAE", "model")
    )


def best_row(table: DataFrame, *order: str) -> DataFrame:
    """First row by ``order``, taken without sorting the table as a whole."""
    return table.orderBy(*order).limit(1)

