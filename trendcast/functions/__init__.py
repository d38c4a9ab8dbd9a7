from trendcast.functions.arrays import first_arg_max
from trendcast.functions.coerce import finite, to_date, to_flag, to_number, to_period_int
from trendcast.functions.labels import feature_group, is_leakage_safe, leakage_reason
from trendcast.functions.periods import GRAINS, period_index, with_period
from trendcast.functions.statistics import safe_corr

__all__ = [
    "GRAINS", "feature_group", "finite", "first_arg_max", "is_leakage_safe",
    "leakage_reason", "period_index", "safe_corr", "to_date", "to_flag",
    "to_number", "to_period_int", "with_period",
]
