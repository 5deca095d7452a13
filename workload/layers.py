"""The layers of the derived feeds, written once per session and input directory.

They stand for the stored tables a daily pipeline leaves behind, so that the queries scan
day-partitioned files as they would in production. They lie in the cluster's shared folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.plans.stored import refresh, replace_parts
from gridmargin.schemas import DATASETS
from gridmargin.session import scratch_dir
from gridmargin.sources.curated import transform
from gridmargin.sources.landing import read_raw
from gridmargin.sources.storage import write_days
from gridmargin.sources.warehouse import read_warehouse, warehouse_columns
from workload import fixtures

_lock = threading.RLock()
_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, layer: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    with _lock:
        if key not in _written:
            path = scratch_dir(spark)
            write(path)
            _written[key] = path
        return _written[key]


def bulk(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The long text tables the daily feeds are extracted from, as Parquet."""
    frame = {"region": fixtures.bulk_region_table, "fuel": fixtures.bulk_fuel_table}[table]

    def write(path: str) -> None:
        rows = frame(spark, sf_dir).withColumn("dt", F.substring("period", 1, 10).cast("date"))
        write_days(rows, path, "dt", "period")

    return spark.read.parquet(_once(spark, sf_dir, f"bulk-{table}", write))


def landing(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """NDJSON of all days, read back as text with the day as ``dt``."""
    spec = DATASETS[dataset]

    def write(path: str) -> None:
        text = fixtures.as_text(fixtures.RAW_FEEDS[spec.table](spark, sf_dir))
        write_days(text, f"{path}/{dataset}", "dt", file_format="json")

    return read_raw(spark, _once(spark, sf_dir, f"landing-{dataset}", write), dataset, spec.raw)


def curated(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Curated Parquet of all days, behind the gates, with the day as ``dt``."""
    spec = DATASETS[dataset]

    def write(path: str) -> None:
        raw = landing(spark, sf_dir, dataset)
        rows = transform(raw, spec, F.col("dt"))
        write_days(rows.withColumn("dt", F.col("ingestion_date")), path, "dt", *spec.key)

    path = _once(spark, sf_dir, f"curated-{dataset}", write)
    return spark.read.parquet(path)


def trade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows that all three trade feeds sum up, joined once."""
    path = _once(spark, sf_dir, "trade", lambda path: fixtures.trade(spark, sf_dir).write.parquet(path))
    return spark.read.parquet(path)


def warehouse(spark: SparkSession, sf_dir: str, dataset: str, trade: bool = False) -> DataFrame:
    """RAW table of all days."""
    spec = DATASETS[dataset]

    def write(path: str) -> None:
        if trade:
            feed = fixtures.trade_feeds(spark, sf_dir, trade_rows(spark, sf_dir))[spec.table]
        else:
            feed = fixtures.RAW_FEEDS[spec.table](spark, sf_dir)
        rows = warehouse_columns(feed, spec, F.col("dt"))
        write_days(rows, f"{path}/{spec.table}", "dt", *spec.key)

    layer = f"warehouse-{'trade' if trade else 'events'}-{dataset}"
    return read_warehouse(spark, _once(spark, sf_dir, layer, write), spec)


def raw_tables(spark: SparkSession, sf_dir: str, trade: bool = False) -> dict[str, DataFrame]:
    return {
        spec.table: warehouse(spark, sf_dir, name, trade) for name, spec in DATASETS.items()
    }


def chain(spark: SparkSession, sf_dir: str) -> str:
    """Root of marts that came all the way: landing, curated, warehouse."""

    def write(path: str) -> None:
        for name, spec in DATASETS.items():
            rows = warehouse_columns(curated(spark, sf_dir, name), spec, F.col("ingestion_date"))
            write_days(rows, f"{path}/warehouse/{spec.table}", "dt", *spec.key)
        refresh(spark, path, f"{path}/warehouse")

    return _once(spark, sf_dir, "chain", write)


def reloaded(spark: SparkSession, sf_dir: str) -> str:
    """Root of marts whose every second day was first loaded wrong and then again."""
    tables = raw_tables(spark, sf_dir)
    second = F.dayofmonth("dt") % 2 == 0

    def write(path: str) -> None:
        for spec in DATASETS.values():
            wrong = tables[spec.table].withColumn("value", F.when(second, F.col("value") * 3 + 1).otherwise(F.col("value")))
            late = wrong.filter(~second | (F.hour("period") < 20))
            write_days(late, f"{path}/warehouse/{spec.table}", "dt", *spec.key)
        refresh(spark, path, f"{path}/warehouse")
        days = {str(r.dt) for t in tables.values() for r in t.filter(second).select("dt").distinct().collect()}
        for spec in DATASETS.values():
            replace_parts(tables[spec.table], f"{path}/warehouse/{spec.table}", "dt", days, *spec.key)
        refresh(spark, path, f"{path}/warehouse", days)

    return _once(spark, sf_dir, "reloaded", write)
