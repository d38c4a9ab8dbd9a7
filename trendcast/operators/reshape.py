"""Wide ↔ long, and calendar-dense series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "name",
    value: str = "value",
    suffix: str | None = None,
) -> DataFrame:
    """One row per (id, column). ``suffix`` picks the columns whose name ends with it."""
    chosen = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    if suffix is not None:
        chosen = [c for c in chosen if c.endswith(suffix)]
    return df.unpivot(list(ids), chosen, name, value)


def to_wide(
    df: DataFrame, ids: Sequence[str], column: str, value: str, values: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One column per listed value, absent cells 0.

    The values are an argument: a sink knows its columns, and naming them saves
    the extra job that would look them up. Plain conditional sums keep the whole
    pivot in one aggregate.
    """
    cells = [
        F.sum(F.when(F.col(column) == v, F.col(value)).otherwise(0)).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(*ids).agg(*cells)


def densify(
    counts: DataFrame,
    keys: Sequence[str] = (),
    period: str = "period",
    target: str = "n",
    start: int | Column | None = None,
    end: int | Column | None = None,
) -> DataFrame:
    """Give every series every period from ``start`` to ``end``, empty cells 0.

    Each row also emits the empty periods up to the next one; the first and last
    row of a series fill the margins, and rows outside the bounds count nowhere.
    No spine table and no join: the only shuffle is by series key, where the lag
    features need the rows anyway. Bounds default to the first and last period of the whole table.
    """
    lo = F.lit(start) if isinstance(start, int) else start
    hi = F.lit(end) if isinstance(end, int) else end
    counts = counts.select(*keys, period, target).filter(F.col(period).isNotNull())
    if lo is None or hi is None:
        # Naming the target too makes this read the very shuffle that the rows come from,
        # so Spark runs the aggregate below it once.
        parts = [F.min(period).alias("lo"), F.max(period).alias("hi"), F.max(target).alias("top")]
        bounds = counts.agg(F.struct(*parts)).scalar()
        lo = bounds["lo"] if lo is None else lo
        hi = bounds["hi"] if hi is None else hi
    w = Window.partitionBy(*keys).orderBy(period)
    p = F.col(period)
    marked = counts.withColumns({
        "__from": F.greatest(F.when(F.lag(period).over(w).isNull(), lo).otherwise(p), lo),
        "__to": F.least(F.coalesce(F.lead(period).over(w) - 1, hi), hi),
    })
    cells = F.when(F.col("__from") <= F.col("__to"), F.sequence("__from", "__to"))
    return marked.select(*keys, F.explode(cells).alias("__cell"), period, target).select(
        *keys,
        F.col("__cell").alias(period),
        F.when(F.col("__cell") == p, F.col(target)).otherwise(0).alias(target),
    )
