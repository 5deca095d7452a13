"""Compare every query with its SQL, as the driver does: ``python -m workload.compare [sf_dir]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from gridmargin.session import get_session
from workload.oracle import ORACLE
from workload.queries import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None if rows, columns and values agree exactly."""
    got = queries()[name](spark, sf_dir)
    found = connection.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    left, right = _rows(got.columns, got.collect()), _rows(columns, found.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows, SQL has {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    connection.execute("set enable_progress_bar = false")
    bad = 0
    for name in queries():
        start = time.perf_counter()
        found = difference(spark, connection, sf_dir, name) if name in ORACLE else "no SQL"
        bad += found is not None
        print(f"{name:45s} {time.perf_counter() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{bad} of {len(queries())} differ")
    spark.stop()


if __name__ == "__main__":
    main()
