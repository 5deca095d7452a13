"""Curated layer: typed columns behind validation gates, Parquet per dataset and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridmargin.functions import parse_period, parse_value, run_date_column
from gridmargin.operators.quality import gate_counts, raise_on_failed_gate
from gridmargin.schemas import DEMAND, GENERATION, INTERCHANGE, Dataset
from gridmargin.sources.storage import day_path, replace_directory


def parsed_columns(df: DataFrame, dataset: Dataset, ingestion_date: date | str | Column) -> DataFrame:
    """Curated columns, followed by the raw text of the parsed ones for the gates."""
    computed = {
        "period": parse_period(F.col("period")),
        "value": parse_value(F.col("value")),
        "ingestion_date": run_date_column(ingestion_date),
    }
    origin = {new: old for old, new in dataset.renames.items()}
    curated = [
        computed.get(name, F.col(f"`{origin.get(name, name)}`")).alias(name)
        for name in dataset.curated.names
    ]
    return df.select(
        *curated,
        F.col("period").alias("period_text"),
        F.col("value").alias("value_text"),
    )


def transform(
    df: DataFrame,
    dataset: Dataset,
    ingestion_date: date | str | Column,
    allow_empty: bool = False,
) -> DataFrame:
    """Curate a raw frame; raises before returning if any gate fails.

    All gates are one aggregation over one scan.
    """
    parsed = parsed_columns(df, dataset, ingestion_date)
    raise_on_failed_gate(parsed.agg(*gate_counts(dataset)).first().asDict(), dataset, allow_empty)
    return parsed.select(*dataset.curated.names)


def transform_demand(df: DataFrame, ingestion_date: date | str) -> DataFrame:
    return transform(df, DEMAND, ingestion_date)


def transform_interchange(df: DataFrame, ingestion_date: date | str) -> DataFrame:
    return transform(df, INTERCHANGE, ingestion_date)


def transform_generation(df: DataFrame, ingestion_date: date | str) -> DataFrame:
    return transform(df, GENERATION, ingestion_date)


def curated_path(base: str, dataset: str, day: date | str) -> str:
    return day_path(base, dataset, day)


def write_curated(df: DataFrame, base: str, dataset: str, day: date | str) -> None:
    """Replace one curated day with the rows of a frame."""
    replace_directory(
        df.sparkSession, curated_path(base, dataset, day), lambda staging: df.write.parquet(staging)
    )


def curate_day(
    raw: DataFrame,
    base: str,
    dataset: Dataset,
    day: date | str,
    allow_empty: bool = False,
) -> None:
    """Parse, check and write one day in a single pass over the raw text.

    The gate counts are observed while the rows are written aside; only if they all pass
    does the result replace the curated day.
    """
    gates = Observation()
    observed = parsed_columns(raw, dataset, day).observe(gates, *gate_counts(dataset))
    replace_directory(
        raw.sparkSession,
        curated_path(base, dataset.name, day),
        lambda staging: observed.select(*dataset.curated.names).write.parquet(staging),
        lambda: raise_on_failed_gate(gates.get, dataset, allow_empty),
    )
