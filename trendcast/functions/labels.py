"""Labels derived from feature names, for report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


# The group of a feature by the start of its name.
FEATURE_GROUPS = {
    "kw_": "keyword_share", "is_": "patent_type_share", "title_": "title_feature", "keyword_score": "title_feature",
}


def feature_group(name: Column, groups: Mapping[str, str] = FEATURE_GROUPS) -> Column:
    """The label of the first prefix in ``groups`` that ``name`` starts with, else ``other``."""
    label = F.lit("other")
    for prefix, group in reversed(groups.items()):
        label = F.when(name.startswith(prefix), group).otherwise(label)
    return label


def is_leakage_safe(name: Column) -> Column:
    """A feature is safe when its value is known before the period it predicts."""
    return (name == "trend") | name.startswith("lag_") | name.endswith("_lag_1")


def leakage_reason(name: Column) -> Column:
    return (
        F.when(name == "trend", "known ahead: the calendar trend is fixed")
        .when(name.startswith("lag_"), "past only: lagged totals")
        .when(name.endswith("_lag_1"), "past only: engineered feature of the previous period")
        .otherwise("unsafe: needs values of the period being predicted")
    )
