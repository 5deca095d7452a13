"""Report queries over the marts; their results are small or one row per input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmargin.operators.counts import domain_counts

# Display order of the categories, the target line and the default unit.
STATUS_ORDER = ["surplus", "adequate", "tight", "deficit", "unknown"]
FLOW_ORDER = ["net_export", "net_import", "balanced"]
TARGET_MARGIN_PERCENT = 13.75
DEFAULT_UNIT = "MWh"


def latest(reliability: DataFrame, generation: DataFrame | None = None) -> DataFrame:
    """The row of the last period; the first respondent where several share it.

    Given the staged generation the mart is built on, the last period is looked up there
    first and reaches every scan below the mart as a filter.
    """
    if generation is not None:
        last = generation.select(F.max("period")).scalar()
        reliability = reliability.filter(F.col("period") == last)
    return reliability.orderBy(F.desc("period"), "respondent").limit(1)


def kpis(latest_row: DataFrame) -> DataFrame:
    """Display texts of the latest row, with the rounded numbers they show."""
    percent = F.bround(F.col("reserve_margin_pct") * 100, 1)
    net = F.col("net_available_generation_mwh")
    return latest_row.select(
        "period",
        "respondent",
        percent.alias("reserve_margin_percent"),
        F.when(percent.isNull(), "nan%")
        .otherwise(F.format_string("%.1f%%", percent))
        .alias("reserve_margin"),
        F.initcap("grid_status").alias("grid_status"),
        F.coalesce(F.format_number(net, 0), F.lit("nan")).alias("net_available_generation"),
    )


def reserve_margin_series(reliability: DataFrame) -> DataFrame:
    """Margins in percent with the constant target beside them."""
    return reliability.select(
        "period",
        "respondent",
        (F.col("reserve_margin_pct") * 100).alias("reserve_margin_percent"),
        F.lit(TARGET_MARGIN_PERCENT).alias("target_percent"),
    )


def status_distribution(reliability: DataFrame) -> DataFrame:
    return domain_counts(reliability, "grid_status", STATUS_ORDER)


def generation_mix_series(demand_vs_generation: DataFrame) -> DataFrame:
    return demand_vs_generation.select("period", "fuel_type", "generation_mwh")


def _first_per_period(demand_vs_generation: DataFrame, column: str) -> DataFrame:
    order = F.struct("respondent", "fuel_type", column)
    return demand_vs_generation.groupBy("period").agg(F.min_by(column, order).alias(column))


def demand_series(demand_vs_generation: DataFrame) -> DataFrame:
    """Demand once per period instead of once per fuel."""
    return _first_per_period(demand_vs_generation, "demand_mwh")


def delta_series(demand_vs_generation: DataFrame) -> DataFrame:
    """Supply-demand delta once per period, with its sign; a null counts as shortfall."""
    delta = F.col("supply_demand_delta_mwh")
    return _first_per_period(demand_vs_generation, "supply_demand_delta_mwh").withColumn(
        "sign", F.when(delta >= 0, "surplus").otherwise("shortfall")
    )


def units_label(balance: DataFrame) -> DataFrame:
    """The first interchange unit that is known, else the default; always one row."""
    known = balance.filter(F.col("interchange_units").isNotNull())
    first = F.min_by("interchange_units", F.struct("period", "respondent", "interchange_units"))
    return known.agg(F.coalesce(first, F.lit(DEFAULT_UNIT)).alias("units"))


def interchange_series(balance: DataFrame) -> DataFrame:
    return balance.select("period", "respondent", "interchange_mwh", "flow_direction")


def flow_distribution(balance: DataFrame) -> DataFrame:
    return domain_counts(balance, "flow_direction", FLOW_ORDER)
