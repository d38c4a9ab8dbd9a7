"""Calendar periods as consecutive integers, so that "next period" is always + 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GRAINS = ("year", "quarter", "month", "day", "hour", "index")


def period_index(col: Column, grain: str) -> Column:
    """Map a time to its period number.

    year: the year itself; quarter and month: counted from year 0; day and hour:
    counted from 1970-01-01. ``index`` takes an integer column as it is.
    Works alike for DATE, TIMESTAMP and TIMESTAMP_NTZ.
    """
    if grain == "year":
        return F.year(col).cast("int")
    if grain == "quarter":
        return (F.year(col) * 4 + F.quarter(col) - 1).cast("int")
    if grain == "month":
        return (F.year(col) * 12 + F.month(col) - 1).cast("int")
    if grain == "day":
        return F.unix_date(col.cast("date")).cast("int")
    if grain == "hour":
        return (F.unix_date(col.cast("date")) * 24 + F.hour(col)).cast("int")
    if grain == "index":
        return col.cast("int")
    raise ValueError(f"unknown grain {grain!r}; use one of {', '.join(GRAINS)}")


def with_period(df: DataFrame, time_col: str, grain: str, period: str = "period") -> DataFrame:
    return df.withColumn(period, period_index(F.col(time_col), grain))
