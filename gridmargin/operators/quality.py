"""Validation gates that raise, and data-quality checks that report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmargin.operators.counts import null_counts, parse_failure_counts
from gridmargin.schemas import DATASETS, Dataset


class DataValidationError(Exception):
    """A dataset failed a gate and must not be written."""


class EmptyDatasetError(DataValidationError):
    """A day came without a single row."""


def _parse_failure(dataset_name: str, raw_col: str, parsed_col: str, count: int) -> DataValidationError:
    return DataValidationError(
        f"[{dataset_name}] {count} row(s) hold text in '{raw_col}' that '{parsed_col}' cannot "
        "represent; nothing was written"
    )


def _null_failure(dataset_name: str, column: str, count: int) -> DataValidationError:
    return DataValidationError(
        f"[{dataset_name}] required column '{column}' is null in {count} row(s); "
        "nothing was written"
    )


def validators_no_parse_failures(
    df: DataFrame, raw_col: str, curated_col: str, dataset_name: str
) -> None:
    """Raise if any non-null raw text has a null parsed value."""
    count = parse_failure_counts(df, {raw_col: curated_col}).first()[raw_col]
    if count:
        raise _parse_failure(dataset_name, raw_col, curated_col, count)


def validators_required_columns_not_null(
    df: DataFrame, required_columns: Sequence[str], dataset_name: str
) -> None:
    """Raise at the first required column that holds nulls; one aggregation for all."""
    counts = null_counts(df, required_columns).first()
    for column in required_columns:
        if counts[column]:
            raise _null_failure(dataset_name, column, counts[column])


# The same gates as aggregate columns, so that they fit one ``agg`` or one ``observe``.

_PARSED = {"period": "period_text", "value": "value_text"}


def null_gate_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def gate_counts(dataset: Dataset) -> list[Column]:
    """Row count, parse failures and required-column nulls of a parsed frame."""
    unparsed = [
        F.count_if(F.col(text).isNotNull() & F.col(parsed).isNull()).alias(f"unparsed_{parsed}")
        for parsed, text in _PARSED.items()
    ]
    return [F.count(F.lit(1)).alias("rows"), *unparsed, *null_gate_counts(dataset.required)]


def raise_on_null_gate(counts: dict[str, int], columns: Sequence[str], name: str) -> None:
    for column in columns:
        if counts[f"null_{column}"]:
            raise _null_failure(name, column, counts[f"null_{column}"])


def raise_on_failed_gate(counts: dict[str, int], dataset: Dataset, allow_empty: bool) -> None:
    """Gate order: empty day, period text, value text, required columns."""
    if not counts["rows"] and not allow_empty:
        raise EmptyDatasetError(f"[{dataset.label}] the day holds no rows; nothing was written")
    for parsed in _PARSED:
        if counts[f"unparsed_{parsed}"]:
            raise _parse_failure(dataset.label, parsed, parsed, counts[f"unparsed_{parsed}"])
    raise_on_null_gate(counts, dataset.required, dataset.label)


# Reporting checks.


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column as rows (column, failures), from one aggregation."""
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    return null_counts(df, columns).select(F.inline(F.array(*rows)))


def unique_combination(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once; null keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


# Which columns each source and model must fill, and which keys are unique.
SOURCE_NOT_NULL = {
    "raw_demand": ["respondent", "period", "dt"],
    "raw_interchange": ["respondent", "period", "dt"],
    "raw_generation_by_fuel": ["respondent", "period", "fuel_type", "dt"],
}
MODEL_NOT_NULL = {
    "stg_demand": ["period", "respondent", "demand_mwh"],
    "stg_interchange": ["period", "respondent", "interchange_mwh"],
    "stg_generation_by_fuel": ["period", "respondent", "fuel_type", "generation_mwh"],
    "mart_demand_vs_generation": [
        "period", "respondent", "fuel_type", "demand_mwh", "total_generation_mwh",
    ],
    "mart_interchange_balance": ["period", "respondent", "interchange_mwh", "flow_direction"],
    "mart_grid_reliability": ["period", "respondent", "demand_mwh", "grid_status"],
}
MODEL_UNIQUE = {
    "stg_demand": ["period", "respondent"],
    "stg_interchange": ["period", "respondent"],
    "stg_generation_by_fuel": ["period", "respondent", "fuel_type"],
    "mart_demand_vs_generation": ["period", "respondent", "fuel_type"],
    "mart_interchange_balance": ["period", "respondent"],
    "mart_grid_reliability": ["period", "respondent"],
}


def not_null_report(frames: dict[str, DataFrame], checks: dict[str, list[str]]) -> DataFrame:
    """(table, column, failures) over several tables, one aggregation each."""
    parts = [
        not_null(frames[name], columns).select(F.lit(name).alias("table"), "column", "failures")
        for name, columns in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def unique_report(frames: dict[str, DataFrame], checks: dict[str, list[str]]) -> DataFrame:
    """(table, columns, failures): how many key combinations repeat per table."""
    parts = [
        unique_combination(frames[name], keys)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(name).alias("table"), F.lit(", ".join(keys)).alias("columns"), "failures")
        for name, keys in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def model_checks(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Null counts and repeated keys of one model as rows (check, columns, failures).

    Both come from the grouping by key, so a model that is a view is evaluated once.
    """
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
    counted = groups.agg(
        F.count_if(F.col("copies") > 1).alias("repeats"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in columns],
    )
    rows = [("not_null", c, f"null_{c}") for c in columns]
    rows.append(("unique_combination", ", ".join(keys), "repeats"))
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check"),
                        F.lit(names).alias("columns"),
                        F.col(count).alias("failures"),
                    )
                    for check, names, count in rows
                ]
            )
        )
    )


def quality_report(frames: dict[str, DataFrame]) -> DataFrame:
    """All checks of sources and models as one table (check, table, columns, failures)."""
    nulls = not_null_report({t: frames[t] for t in SOURCE_NOT_NULL}, SOURCE_NOT_NULL)
    parts = [
        nulls.select(
            F.lit("not_null").alias("check"), "table", F.col("column").alias("columns"), "failures"
        )
    ]
    for name, keys in MODEL_UNIQUE.items():
        checks = model_checks(frames[name], MODEL_NOT_NULL[name], keys)
        parts.append(checks.select("check", F.lit(name).alias("table"), "columns", "failures"))
    return reduce(DataFrame.unionByName, parts)


def warehouse_key_repeats(frames: dict[str, DataFrame]) -> DataFrame:
    """Repeats of the (unenforced) primary keys of the warehouse tables."""
    return unique_report(frames, {d.table: list(d.key) for d in DATASETS.values()})
