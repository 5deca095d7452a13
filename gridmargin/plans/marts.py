"""The three marts, as lazy DataFrames over the staging projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmargin.functions import flow_direction, grid_status, net_available, reserve_margin
from gridmargin.operators.joins import join_balance, join_generation_demand
from gridmargin.operators.totals import (
    BASE_COLUMNS,
    POOLED,
    holds_hours,
    hourly_totals,
    reliability_base,
    reliability_base_from_staging,
    with_totals,
)
from gridmargin.sources.storage import replace_directory, write_days


def demand_vs_generation(
    generation: DataFrame,
    demand: DataFrame,
    total_keys: Sequence[str] = POOLED,
    repeats: bool = False,
) -> DataFrame:
    """Generation per fuel beside demand, the hour's generation total and their delta.

    ``repeats`` says that generation or demand keys repeat, as the uniqueness checks report.
    """
    joined = join_generation_demand(generation, demand, repeats)
    if holds_hours(total_keys) and not repeats:
        return with_totals(joined, total_keys)
    return with_totals(joined, total_keys, hourly_totals(generation, demand, total_keys), repeats)


def interchange_balance(interchange: DataFrame, *more: str) -> DataFrame:
    """Net interchange with the direction of the flow, and ``more`` columns."""
    return interchange.select(
        "period",
        "respondent",
        "interchange_mwh",
        "interchange_units",
        flow_direction(F.col("interchange_mwh")).alias("flow_direction"),
        *more,
    )


def _with_metrics(hours: DataFrame) -> DataFrame:
    net = net_available(F.col("total_generation_mwh"), F.col("interchange_mwh"))
    margin = reserve_margin(F.col("net_available_generation_mwh"), F.col("demand_mwh"))
    return (
        hours.select(
            *BASE_COLUMNS,
            "interchange_mwh",
            "flow_direction",
            net.alias("net_available_generation_mwh"),
        )
        .withColumn("reserve_margin_pct", margin)
        .withColumn("grid_status", grid_status(F.col("reserve_margin_pct")))
    )


def grid_reliability(
    demand_vs_generation_mart: DataFrame, balance: DataFrame, repeats: bool = False
) -> DataFrame:
    """Reserve margin and status per hour and respondent, from the two other marts.

    ``repeats`` says that interchange keys repeat, as the uniqueness check reports.
    """
    base = reliability_base(demand_vs_generation_mart)
    return _with_metrics(join_balance(base, balance, repeats))


def grid_reliability_from_staging(
    generation: DataFrame,
    demand: DataFrame,
    interchange: DataFrame,
    total_keys: Sequence[str] = POOLED,
    repeats: bool = False,
) -> DataFrame:
    """The same rows straight from staging; the rows per fuel are never shuffled whole.

    Every table is read once. With ``repeats`` the interchange comes last, as the only join in
    its stage. Repeats of generation and demand rows collapse in any case.
    """
    base = reliability_base_from_staging(generation, demand, total_keys, repeats)
    return _with_metrics(join_balance(base, interchange_balance(interchange), repeats))


def write_mart(mart: DataFrame, path: str) -> None:
    """Store a mart that has a ``report_date``, partitioned by it, replacing an earlier one."""
    replace_directory(
        mart.sparkSession,
        path,
        lambda staging: write_days(mart, staging, "report_date", "respondent", "period"),
    )
