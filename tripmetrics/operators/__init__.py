"""DataFrame -> DataFrame steps, all lazy."""

from tripmetrics.operators.cleaning import (
    derive,
    fill_defaults,
    impute_mean,
    rename,
    with_duration,
)
from tripmetrics.operators.conform import conform, conform_profile, union_all
from tripmetrics.operators.enrich import broadcast_if_small, enrich, left_join_dimension
from tripmetrics.operators.rules import (
    all_hold,
    apply_rules,
    cleaning_report,
    rule_rejects,
    spot_check,
    trip_rules,
    violations,
)

__all__ = [
    "all_hold",
    "apply_rules",
    "broadcast_if_small",
    "cleaning_report",
    "conform",
    "conform_profile",
    "derive",
    "enrich",
    "fill_defaults",
    "impute_mean",
    "left_join_dimension",
    "rename",
    "rule_rejects",
    "spot_check",
    "trip_rules",
    "union_all",
    "violations",
    "with_duration",
]
