"""Staging projections over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _staged(raw: DataFrame, measure: str, *extra: str) -> DataFrame:
    return raw.select(
        "respondent",
        *extra,
        "period",
        F.col("value").alias(f"{measure}_mwh"),
        F.col("value_units").alias(f"{measure}_units"),
        F.col("dt").alias("report_date"),
    )


def stg_demand(raw_demand: DataFrame) -> DataFrame:
    return _staged(raw_demand, "demand")


def stg_interchange(raw_interchange: DataFrame) -> DataFrame:
    return _staged(raw_interchange, "interchange")


def stg_generation_by_fuel(raw_generation: DataFrame) -> DataFrame:
    return _staged(raw_generation, "generation", "fuel_type")
