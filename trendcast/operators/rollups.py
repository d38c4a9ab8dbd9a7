"""Events to period tables. Every roll-up is one partial-aggregated ``groupBy``.

Results stay in long form, keyed by (series keys, period); pivot at the sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F

from trendcast.operators.cleaning import present


def period_rollup(
    df: DataFrame,
    keys: Sequence[str] = (),
    period: str = "period",
    flags: Sequence[str] = (),
    types: Sequence[str] = (),
    measures: Sequence[str] = (),
    target: str = "n",
) -> DataFrame:
    """Count, flag sums and shares, type sums and shares, and measure means in one pass.

    Flag shares divide by the row count, type shares by the sum of the type
    flags. Callers select what they need; Catalyst drops the other aggregates
    and does not read their columns.
    """
    flags, types, measures = present(df, flags), present(df, types), present(df, measures)
    sums = dict.fromkeys([*flags, *types])
    base = df.groupBy(*keys, period).agg(
        F.count(F.lit(1)).alias(target),
        *[F.sum(F.col(c).cast("long")).alias(c) for c in sums],
        *[F.avg(F.col(c).cast("double")).alias(f"__mean_{c}") for c in measures],
    )
    type_total = reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in types]) if types else None
    shares = {c: F.try_divide(F.col(c), F.col(target)).alias(f"{c}_share") for c in flags}
    shares |= {c: F.try_divide(F.col(c), type_total).alias(f"{c}_share") for c in types}
    return base.select(
        *keys, period, target, *sums, *shares.values(),
        *[F.col(f"__mean_{c}").alias(c) for c in measures],
    )


def period_counts(df: DataFrame, keys: Sequence[str] = (), period: str = "period", target: str = "n") -> DataFrame:
    return df.groupBy(*keys, period).agg(F.count(F.lit(1)).alias(target))


def flag_trends(df: DataFrame, flags: Sequence[str], keys: Sequence[str] = (), period: str = "period") -> DataFrame:
    """Sum of each flag per period; also serves type flags."""
    flags = present(df, flags)
    return period_rollup(df, keys, period, flags=flags).select(*keys, period, *flags)


def flag_shares(df: DataFrame, flags: Sequence[str], keys: Sequence[str] = (), period: str = "period") -> DataFrame:
    flags = present(df, flags)
    return period_rollup(df, keys, period, flags=flags).select(*keys, period, *[f"{c}_share" for c in flags])


def type_shares(df: DataFrame, types: Sequence[str], keys: Sequence[str] = (), period: str = "period") -> DataFrame:
    types = present(df, types)
    return period_rollup(df, keys, period, types=types).select(*keys, period, *[f"{c}_share" for c in types])


def measure_means(
    df: DataFrame, measures: Sequence[str], keys: Sequence[str] = (), period: str = "period"
) -> DataFrame:
    """Mean of each available measure per period; an empty table if there is none."""
    measures = present(df, measures)
    if not measures:
        return df.select(*keys, period).limit(0)
    return period_rollup(df, keys, period, measures=measures).select(*keys, period, *measures)


def top_values(counts: DataFrame, column: str, top_n: int, weight: str = "n") -> DataFrame:
    """The N heaviest values; a tie goes to the smaller value."""
    return (
        counts.groupBy(column).agg(F.sum(weight).alias("total"))
        .orderBy(F.desc("total"), column)
        .limit(top_n)
    )


def segment_trends(
    df: DataFrame,
    segment: str,
    top_n: int | None = None,
    keys: Sequence[str] = (),
    period: str = "period",
    target: str = "n",
) -> DataFrame:
    """Rows per (period, segment value), NULL counted as 'missing'.

    With ``top_n`` every value outside the N most frequent becomes 'other'. The
    events are counted first; ranking and relabelling run on the counts, and the
    joined side never has more than N rows.
    """
    value = F.coalesce(F.col(segment).cast("string"), F.lit("missing")).alias(segment)
    counts = df.select(*keys, period, value).groupBy(*keys, period, segment).agg(F.count(F.lit(1)).alias(target))
    if top_n is None:
        return counts
    top = top_values(counts, segment, top_n, target).select(F.col(segment), F.lit(True).alias("__top"))
    label = F.when(F.col("__top"), F.col(segment)).otherwise("other")
    return (
        counts.join(F.broadcast(top), segment, "left")
        .withColumn(segment, label)
        .groupBy(*keys, period, segment).agg(F.sum(target).alias(target))
    )


def segment_shares(
    trends: DataFrame, segment: str, keys: Sequence[str] = (), period: str = "period", target: str = "n"
) -> DataFrame:
    """Share of each segment within its period.

    The totals come from a second, map-side combined aggregate rather than a
    window, so a period with very many segment values is not gathered in a task.
    """
    on = [*keys, period]
    totals = trends.groupBy(*on).agg(F.sum(target).alias("__total"))
    return trends.join(totals, on).select(
        *on, segment, target, F.try_divide(F.col(target), F.col("__total")).alias("share")
    )


def period_summary(df: DataFrame, period: str = "period", n_columns: int | None = None) -> DataFrame:
    """One row: rows, columns, first and last period, total, mean, largest and smallest period count."""
    counts = period_counts(df, period=period)
    total = F.coalesce(F.sum("n"), F.lit(0))
    return counts.agg(
        total.alias("n_rows"),
        F.lit(len(df.columns) if n_columns is None else n_columns).alias("n_columns"),
        F.min(period).alias("start_period"),
        F.max(period).alias("end_period"),
        F.coalesce(F.sum(F.when(F.col(period).isNotNull(), F.col("n"))), F.lit(0)).alias("total"),
        F.coalesce(F.avg(F.when(F.col(period).isNotNull(), F.col("n"))), F.lit(0.0)).alias("average_per_period"),
        F.coalesce(F.max(F.when(F.col(period).isNotNull(), F.col("n"))), F.lit(0)).alias("max_in_a_period"),
        F.coalesce(F.min(F.when(F.col(period).isNotNull(), F.col("n"))), F.lit(0)).alias("min_in_a_period"),
    )
