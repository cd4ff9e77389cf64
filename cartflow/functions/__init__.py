"""Column-expression helpers (JVM-side, codegen friendly; no UDFs)."""

from cartflow.functions.timefn import (
    day_of_week,
    hour_of_day,
    minute_diff,
    minute_index,
    month_diff,
    month_start,
)
from cartflow.functions.ratios import count_if, ratio_or_null, safe_divide
from cartflow.functions.labels import decile_label, depth_segment

__all__ = [
    "count_if",
    "day_of_week",
    "decile_label",
    "depth_segment",
    "hour_of_day",
    "minute_diff",
    "minute_index",
    "month_diff",
    "month_start",
    "ratio_or_null",
    "safe_divide",
]
