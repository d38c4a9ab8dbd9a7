"""Aggregate expressions that are NULL, not an error, on constant input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both sides are present; NULL if either is constant."""
    both = x.isNotNull() & y.isNotNull()
    xb = F.when(both, x.cast("double"))
    yb = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_samp(xb, yb), F.stddev_samp(xb) * F.stddev_samp(yb))
