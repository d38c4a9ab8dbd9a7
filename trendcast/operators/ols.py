"""Ordinary least squares for one or very many series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


def _least_squares(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Centred minimum-norm solution, the same for full-rank and collinear features."""
    x_mean, y_mean = x.mean(axis=0), y.mean()
    coef = np.linalg.lstsq(x - x_mean, y - y_mean, rcond=None)[0]
    return float(y_mean - x_mean @ coef), coef


def _key_fields(df: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in by]


def fit_ols(df: DataFrame, features: Sequence[str], target: str = "n", by: Sequence[str] = ()) -> DataFrame:
    """Intercept and coefficients per group, as a table (by…, intercept, coef, n_rows).

    One feature needs only the built-in regression aggregates. With more, each
    group goes to NumPy: a group is one series (in one window), so its size is
    bounded by the calendar and does not grow with the events behind it.
    """
    features, by = list(features), list(by)
    if len(features) == 1:
        x, y = F.col(features[0]).cast("double"), F.col(target).cast("double")
        return df.groupBy(*by).agg(
            F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("intercept"),
            F.array(F.coalesce(F.regr_slope(y, x), F.lit(0.0))).alias("coef"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    schema = T.StructType([
        *_key_fields(df, by),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("n_rows", T.LongType()),
    ])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[features].to_numpy(float)
        intercept, coef = _least_squares(x, pdf[target].to_numpy(float))
        row = {c: [pdf[c].iloc[0]] for c in by}
        return pd.DataFrame(row | {"intercept": [intercept], "coef": [coef.tolist()], "n_rows": [len(pdf)]})

    return df.select(*by, target, *features).groupBy(*by).applyInPandas(fit, schema)


def ols_holdout(
    df: DataFrame,
    features: Sequence[str],
    target: str = "n",
    by: Sequence[str] = (),
    period: str = "period",
    role: str = "role",
    train_role: str = "train",
) -> DataFrame:
    """Fit on the rows of a group whose role is 'train' and predict its other rows.

    Fit and prediction share one grouped pass, so the coefficients are never
    joined back. Returns (by…, period, actual, predicted) and the first period
    and number of the training rows; a group without training rows gives none.
    """
    features, by = list(features), list(by)
    schema = T.StructType([
        *_key_fields(df, by),
        df.schema[period],
        T.StructField("actual", T.DoubleType()),
        T.StructField("predicted", T.DoubleType()),
        T.StructField("train_start", df.schema[period].dataType),
        T.StructField("n_train", T.LongType()),
    ])
    names = schema.fieldNames()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        is_train = (pdf[role] == train_role).to_numpy()
        held = pdf[~is_train]
        if not is_train.any() or held.empty:
            return pd.DataFrame(columns=names)
        x, y = pdf[features].to_numpy(float), pdf[target].to_numpy(float)
        intercept, coef = _least_squares(x[is_train], y[is_train])
        out = held[[*by, period]].copy()
        out["actual"] = y[~is_train]
        out["predicted"] = intercept + x[~is_train] @ coef
        out["train_start"] = pdf.loc[is_train, period].min()
        out["n_train"] = int(is_train.sum())
        return out

    needed = [*by, period, role, target, *features]
    return df.select(*dict.fromkeys(needed)).groupBy(*by).applyInPandas(run, schema)
