from ovenplan.functions.calendar import (
    WEEKDAY_NAMES,
    calendar_columns,
    cyclic_columns,
    day_of_week,
    is_weekend,
    month_label,
    weekday_name,
)
from ovenplan.functions.numeric import (
    clamp_zero,
    exact_avg,
    floored_ratio,
    guarded_ratio,
    money_sum,
    pct_diff,
    round_half_even,
    round_to_long,
    units,
    zero_sum,
)

__all__ = [
    "WEEKDAY_NAMES",
    "calendar_columns",
    "clamp_zero",
    "cyclic_columns",
    "day_of_week",
    "exact_avg",
    "floored_ratio",
    "guarded_ratio",
    "is_weekend",
    "money_sum",
    "month_label",
    "pct_diff",
    "round_half_even",
    "round_to_long",
    "units",
    "weekday_name",
    "zero_sum",
]
