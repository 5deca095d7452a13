"""Replacing a directory as a whole, and writing many days at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def day_path(base: str, dataset: str, day: date | str) -> str:
    return f"{base.rstrip('/')}/{dataset}/dt={day}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether a directory holds at least one file that matches the glob pattern."""
    fs, directory = _file_system(spark, path)
    matches = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(directory, pattern))
    return matches is not None and len(matches) > 0


def replace_directory(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    check: Callable[[], None] | None = None,
) -> None:
    """Write aside, check, then swap the result in for whatever ``path`` held.

    A failing write or check leaves the previous content alone. The staging directory
    starts with an underscore, which Spark's readers skip, and lies beside the target so
    that the swap is a rename on file systems that have one. Should the driver die between
    the two renames, the previous content is still there as ``_previous-*``.
    """
    fs, target = _file_system(spark, path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    token = uuid.uuid4().hex
    staging = hadoop_path(target.getParent(), f"_staging-{token}")
    previous = hadoop_path(target.getParent(), f"_previous-{token}")
    try:
        write(staging.toString())
        if check is not None:
            check()
        had_previous = fs.exists(target)
        if had_previous and not fs.rename(target, previous):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(staging, target):
            if had_previous:
                fs.rename(previous, target)
            raise OSError(f"could not move the new content to {path}")
        if had_previous:
            fs.delete(previous, True)
    finally:
        if fs.exists(staging):
            fs.delete(staging, True)


def write_days(df: DataFrame, path: str, day: str, *sort: str, file_format: str = "parquet") -> None:
    """Write a table of many days, one directory per day.

    The rebalance hint lets AQE split a day that holds far more rows than the others and
    merge small ones, so neither one task nor a swarm of tiny files results. Sorting inside
    the tasks keeps a respondent's hours together, for row-group skipping later.
    """
    writer = df.hint("rebalance", day).sortWithinPartitions(day, *sort).write
    if file_format == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.mode("overwrite").partitionBy(day).format(file_format).save(path)
