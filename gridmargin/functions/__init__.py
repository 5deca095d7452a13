"""Column expressions shared by the operators."""

from gridmargin.functions.columns import (
    PERIOD_FORMAT,
    exact_difference,
    exact_sum,
    exact_times,
    flow_direction,
    grid_status,
    interchange_defaults,
    net_available,
    parse_period,
    parse_value,
    reserve_margin,
    run_date_column,
)

__all__ = [
    "PERIOD_FORMAT",
    "exact_difference",
    "exact_sum",
    "exact_times",
    "flow_direction",
    "grid_status",
    "interchange_defaults",
    "net_available",
    "parse_period",
    "parse_value",
    "reserve_margin",
    "run_date_column",
]
