"""Warehouse layer: day-partitioned RAW tables with idempotent day loads."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmargin.functions import run_date_column
from gridmargin.operators.quality import null_gate_counts, raise_on_null_gate
from gridmargin.schemas import DEMAND, GENERATION, INTERCHANGE, Dataset
from gridmargin.sources.curated import curated_path
from gridmargin.sources.storage import day_path, has_files
from gridmargin.sources.versions import read_versions, replace_version

_PARQUET_FILES = "*.parquet"


def warehouse_columns(curated: DataFrame, dataset: Dataset, day: date | str | Column) -> DataFrame:
    """Cast curated columns to the table's types and append the partition day.

    The casts are the raising kind: one bad row aborts the load. A column the files lack
    reads as null, so a missing required column fails the not-null check.
    """
    present = set(curated.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dataset.warehouse.fields
        if f.name != "dt"
    ]
    return curated.select(*columns, run_date_column(day).alias("dt"))


def load_day(
    spark: SparkSession,
    curated_base: str,
    warehouse_base: str,
    dataset: Dataset,
    run_date: date | str | None,
) -> str:
    """Load one curated day, replacing the table's partition for that day.

    Only ``*.parquet`` files count. A day without files is loaded as empty, which clears
    the partition. A new version of the partition does that; dynamic partition overwrite would
    keep the old rows of an empty day. Readers see the old day or the new one at any time.
    """
    if run_date is None:
        raise ValueError("run_date must not be null")
    day = date.fromisoformat(str(run_date)).isoformat()
    source = curated_path(curated_base, dataset.name, day)
    if has_files(spark, source, _PARQUET_FILES):
        curated = spark.read.option("pathGlobFilter", _PARQUET_FILES).parquet(source)
    else:
        curated = spark.createDataFrame([], dataset.curated)
    nulls = Observation()
    rows = warehouse_columns(curated, dataset, day).observe(
        nulls, *null_gate_counts(dataset.required_in_warehouse)
    )
    replace_version(
        spark,
        day_path(warehouse_base, dataset.table, day),
        lambda staging: rows.drop("dt").sortWithinPartitions(*dataset.key).write.parquet(staging),
        lambda: raise_on_null_gate(nulls.get, dataset.required_in_warehouse, dataset.table),
    )
    return f"{dataset.table} loaded for dt={day}"


def load_raw_demand(
    spark: SparkSession, curated_base: str, warehouse_base: str, run_date: date | str | None
) -> str:
    return load_day(spark, curated_base, warehouse_base, DEMAND, run_date)


def load_raw_interchange(
    spark: SparkSession, curated_base: str, warehouse_base: str, run_date: date | str | None
) -> str:
    return load_day(spark, curated_base, warehouse_base, INTERCHANGE, run_date)


def load_raw_generation_by_fuel(
    spark: SparkSession, curated_base: str, warehouse_base: str, run_date: date | str | None
) -> str:
    return load_day(spark, curated_base, warehouse_base, GENERATION, run_date)


def read_warehouse(
    spark: SparkSession,
    warehouse_base: str,
    dataset: Dataset,
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """A RAW table under its declared schema; a filter on ``dt`` prunes directories.

    A table no day was loaded into yet is empty. With ``days`` only their folders are listed.
    """
    table = f"{warehouse_base.rstrip('/')}/{dataset.table}"
    return read_versions(spark, table, dataset.warehouse, days=days)
