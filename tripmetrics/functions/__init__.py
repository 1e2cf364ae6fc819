"""Column expressions: built-in Spark functions only."""

from tripmetrics.functions.expressions import (
    code_label,
    duration_minutes,
    exact_mean,
    fitting_cast,
    kilometres,
    month_label,
    without_nan,
)

__all__ = [
    "code_label",
    "duration_minutes",
    "exact_mean",
    "fitting_cast",
    "kilometres",
    "month_label",
    "without_nan",
]
