"""What the two operators on vectors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """False for vectors that are null, zero, or hold null or non-finite components."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def doubles(df: DataFrame, vector: str) -> Column:
    return df[vector].cast("array<double>")
