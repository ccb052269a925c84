"""Column expressions shared by models, queries and tests."""

from .measures import US_SUM_TYPE, cell_label, grid, mean_hours, mean_us, us_sum
from .timefns import (
    MICROS_PER_HOUR,
    as_ntz,
    day_start,
    days_before,
    display_local,
    epoch_micros,
    hours_between,
    micros_between,
    month_start,
    months_before_month_start,
    to_timestamp_lenient,
    zone_offset_hours,
)

__all__ = [
    "MICROS_PER_HOUR", "as_ntz", "cell_label", "day_start", "days_before", "display_local", "epoch_micros", "grid",
    "hours_between", "mean_hours", "micros_between", "month_start", "months_before_month_start",
    "mean_us", "us_sum", "US_SUM_TYPE", "to_timestamp_lenient", "zone_offset_hours",
]
