"""Correlation and feature-evidence tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from trendcast.functions.labels import FEATURE_GROUPS, feature_group
from trendcast.functions.statistics import safe_corr
from trendcast.operators.cleaning import present


def flag_correlation(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Pearson matrix of flags in long form (feature_a, feature_b, r), over rows where both are present.

    Equal rows of flags are counted first, where they are read; few are left where flags are 0/1. The pairs of a row are
    then rows of their own, summed by pair, so the plan does not grow with the flags. Values are taken from their
    column's mean, which keeps the sums of products exact enough. A constant flag has no correlation.
    """
    flags = present(df, flags)
    if not flags:
        return df.select(F.lit("").alias("feature_a"), F.lit("").alias("feature_b"), F.lit(0.0).alias("r")).limit(0)
    names = [f"x{i}" for i in range(len(flags))]
    counted = df.groupBy(*[F.col(f).cast("double").alias(x) for f, x in zip(flags, names)]).agg(F.count("*").alias("w"))
    mean = counted.agg(F.array(*[F.coalesce(F.try_divide(
        F.sum(F.col(x) * F.col("w")), F.sum(F.when(F.col(x).isNotNull(), F.col("w")))), F.lit(0.0)) for x in names])).scalar()
    rows = counted.select("w", F.array(*names).alias("x"), mean.alias("m")).select(
        "w", F.zip_with("x", "m", lambda x, m: x - m).alias("x"))
    i, j = F.col("p.i"), F.col("p.j")
    pairs = F.array(*[
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in range(len(flags)) for b in range(a, len(flags))])
    cells = rows.select("w", F.explode(pairs).alias("p"), "x").select("w", i.alias("i"), j.alias("j"), F.get("x", i).alias(
        "a"), F.get("x", j).alias("b")).where("a is not null and b is not null")
    w, a, b = F.col("w"), F.col("a"), F.col("b")
    sums = cells.groupBy("i", "j").agg(
        F.sum("w").alias("n"), F.sum(w * a).alias("sa"), F.sum(w * b).alias("sb"), F.sum(w * a * a).alias("saa"),
        F.sum(w * b * b).alias("sbb"), F.sum(w * a * b).alias("sab"), F.min(a).alias("la"), F.max(a).alias("ma"),
        F.min(b).alias("lb"), F.max(b).alias("mb"))
    n = F.col("n")
    varied = (n > 1) & (F.col("la") < F.col("ma")) & (F.col("lb") < F.col("mb"))
    top = F.col("sab") - F.col("sa") * F.col("sb") / n
    spread = F.sqrt(F.col("saa") - F.col("sa") * F.col("sa") / n) * F.sqrt(F.col("sbb") - F.col("sb") * F.col("sb") / n)
    r = F.when(varied & (F.col("i") == F.col("j")), F.lit(1.0)).when(varied, F.try_divide(top, spread))
    return _mirrored(sums.select("i", "j", r.alias("r")), flags)


def _mirrored(half: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The whole matrix from its upper triangle; pairs that no row has both flags of have no correlation."""
    found = F.map_from_entries(F.collect_list(F.struct(F.struct("i", "j").alias("key"), "r")))
    rows = F.array(*[
        F.struct(F.lit(flags[a]).alias("feature_a"), F.lit(flags[b]).alias("feature_b"), F.lit(min(a, b)).alias("i"),
                 F.lit(max(a, b)).alias("j")) for a in range(len(flags)) for b in range(len(flags))])
    cells = half.agg(found.alias("found")).select("found", F.explode(rows).alias("c"))
    return cells.select("c.feature_a", "c.feature_b", F.col("found")[F.struct("c.i", "c.j")].alias("r"))


def feature_evidence(
    period_df: DataFrame, features: Sequence[str], target: str = "n", digits: int = 4,
    groups: Mapping[str, str] = FEATURE_GROUPS,
) -> DataFrame:
    """Missing count, mean, sample deviation and correlation with the target per feature.

    The period table is small, so the features are stacked and summarised by
    name. Sorted by absolute correlation, then name; a constant feature has no
    correlation and sorts last.
    """
    features = present(period_df, features)
    doubles = [F.col(c).cast("double").alias(c) for c in features]
    long = period_df.select(F.col(target).alias("__y"), *doubles).unpivot("__y", features, "feature", "x")
    r = F.round("__r", digits)
    return (
        long.groupBy("feature").agg(
            F.count_if(F.col("x").isNull()).alias("missing_count"),
            F.round(F.avg("x"), digits).alias("mean"),
            F.round(F.stddev_samp("x"), digits).alias("std"),
            safe_corr(F.col("x"), F.col("__y")).alias("__r"),
        )
        .select(
            "feature", feature_group(F.col("feature"), groups).alias("feature_group"), "missing_count", "mean", "std",
            r.alias("correlation_with_target"), F.abs(r).alias("abs_correlation_with_target"))
        .orderBy(F.desc_nulls_last("abs_correlation_with_target"), "feature")
    )


def top_evidence(evidence: DataFrame, n: int = 8) -> DataFrame:
    return evidence.orderBy(F.desc_nulls_last("abs_correlation_with_target"), "feature").limit(n)
