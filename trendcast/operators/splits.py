"""Chronological splits, rolling-origin windows and parameter grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Window(NamedTuple):
    """Train on periods up to ``train_end``, validate on [val_start, val_end]."""

    train_end: int
    val_start: int
    val_end: int


def chrono_split(
    df: DataFrame, train_end: int, val_end: int, val_start: int | None = None, period: str = "period"
) -> DataFrame:
    """Label rows train / validation / test; rows in a gap before ``val_start`` are dropped."""
    p = F.col(period)
    first = train_end + 1 if val_start is None else val_start
    label = (
        F.when(p <= train_end, "train")
        .when(p.between(first, val_end), "validation")
        .when(p > val_end, "test")
    )
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def window_array(windows: Sequence[Window]) -> Column:
    """The windows as one constant array, numbered from 1."""
    return F.array(*[
        F.struct(
            F.lit(i).alias("window_id"),
            F.lit(w.train_end).alias("train_end"),
            F.lit(w.val_start).alias("val_start"),
            F.lit(w.val_end).alias("val_end"),
        )
        for i, w in enumerate(windows, start=1)
    ])


def window_rows(df: DataFrame, windows: Sequence[Window], period: str = "period") -> DataFrame:
    """Repeat each row once per window it plays a role in, with ``window_id`` and ``role``.

    The windows are a short list fixed by the caller, so they travel inside the
    expression: no join, no shuffle, and only matching rows are emitted.
    """
    p = F.col(period)
    inside = F.filter(window_array(windows), lambda w: (p <= w["train_end"]) | p.between(w["val_start"], w["val_end"]))
    return df.select("*", F.explode(inside).alias("__w")).select(
        *df.columns, "__w.*", F.when(p <= F.col("__w.train_end"), "train").otherwise("validation").alias("role")
    )


def parameter_grid(lists: Mapping[str, Sequence[float]]) -> list[dict[str, float]]:
    """Every combination of the listed values, last name varying fastest."""
    return [dict(zip(lists, values)) for values in product(*lists.values())]
