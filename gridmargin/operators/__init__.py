"""DataFrame operators: joins, totals, counts and data-quality checks."""

from gridmargin.operators.counts import (
    domain_counts,
    loaded_row_counts,
    null_counts,
    parse_failure_counts,
    rows_per_fuel,
)
from gridmargin.operators.joins import join_generation_demand, join_reliability_interchange
from gridmargin.operators.quality import (
    DataValidationError,
    EmptyDatasetError,
    not_null,
    unique_combination,
    validators_no_parse_failures,
    validators_required_columns_not_null,
)
from gridmargin.operators.totals import (
    hourly_totals,
    reliability_base,
    reliability_base_from_staging,
    with_totals,
)

__all__ = [
    "DataValidationError",
    "EmptyDatasetError",
    "domain_counts",
    "hourly_totals",
    "join_generation_demand",
    "join_reliability_interchange",
    "loaded_row_counts",
    "not_null",
    "null_counts",
    "parse_failure_counts",
    "reliability_base",
    "reliability_base_from_staging",
    "rows_per_fuel",
    "unique_combination",
    "validators_no_parse_failures",
    "validators_required_columns_not_null",
    "with_totals",
]
