"""Staging and marts as temporary views over the warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridmargin.operators.totals import POOLED
from gridmargin.plans.marts import (
    demand_vs_generation,
    grid_reliability_from_staging,
    interchange_balance,
)
from gridmargin.plans.staging import stg_demand, stg_generation_by_fuel, stg_interchange
from gridmargin.schemas import DATASETS
from gridmargin.sources.warehouse import read_warehouse


def models(
    raw: dict[str, DataFrame], total_keys: Sequence[str] = POOLED, repeats: bool = False
) -> dict[str, DataFrame]:
    """Every staging and mart frame by name, from the RAW frames by table name.

    ``repeats`` says that some warehouse key repeats, as ``warehouse_key_repeats`` reports.
    """
    demand = stg_demand(raw["raw_demand"])
    interchange = stg_interchange(raw["raw_interchange"])
    generation = stg_generation_by_fuel(raw["raw_generation_by_fuel"])
    return {
        "stg_demand": demand,
        "stg_interchange": interchange,
        "stg_generation_by_fuel": generation,
        "mart_demand_vs_generation": demand_vs_generation(
            generation, demand, total_keys, repeats
        ),
        "mart_interchange_balance": interchange_balance(interchange),
        "mart_grid_reliability": grid_reliability_from_staging(
            generation, demand, interchange, total_keys, repeats
        ),
    }


def register_views(
    spark: SparkSession,
    warehouse_base: str,
    total_keys: Sequence[str] = POOLED,
    repeats: bool = False,
) -> dict[str, DataFrame]:
    """Register RAW tables, staging and marts as temp views; returns them by name."""
    raw = {d.table: read_warehouse(spark, warehouse_base, d) for d in DATASETS.values()}
    frames = {**raw, **models(raw, total_keys, repeats)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return frames


def load_mart(
    spark: SparkSession,
    name: str,
    cached: bool = False,
    base: str | None = None,
    total_keys: Sequence[str] = POOLED,
) -> DataFrame:
    """A mart by name; ``cached`` keeps it for a series of report queries.

    With ``base`` the stored mart under that root, in any session; else the session's view.
    """
    if base is None:
        mart = spark.table(name)
    else:
        from gridmargin.plans.stored import load_stored_mart

        mart = load_stored_mart(spark, base, name, total_keys)
    return mart.cache() if cached else mart
