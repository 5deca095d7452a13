"""Landing layer: extract from the bulk feed, NDJSON per dataset and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from gridmargin.sources.storage import day_path, replace_directory


def select_facets(
    bulk: DataFrame,
    facets: dict[str, list[str]],
    start: str,
    end: str,
) -> DataFrame:
    """Rows of a bulk hourly table that pass the facets and lie in the window, in any order.

    Values within a facet are alternatives, facets restrict each other, and an empty facet
    does not restrict. Both ends of the window belong to it. The filters are plain
    comparisons, so a Parquet-backed table receives them in its scan. If the table is stored by
    day, in a column ``dt``, the window also prunes its directories.
    """
    selected = bulk.filter(F.col("period").between(start, end))
    if "dt" in bulk.columns:
        days = [F.lit(hour[:10]).cast("date") for hour in (start, end)]
        selected = selected.filter(F.col("dt").between(*days))
    for name, values in facets.items():
        if values:
            selected = selected.filter(F.col(name).isin(values))
    return selected.drop("dt")


def extract(
    bulk: DataFrame,
    facets: dict[str, list[str]],
    start: str,
    end: str,
) -> DataFrame:
    """What :func:`select_facets` gives, sorted by hour.

    Sorting by the other text columns after ``period`` lets the range partitioning split an
    hour that holds a large share of the rows.
    """
    selected = select_facets(bulk, facets, start, end)
    ties = [f"`{c}`" for c in selected.columns if c not in ("period", "value", "value-units")]
    return selected.orderBy("period", *ties)


def landing_path(base: str, dataset: str, day: date | str) -> str:
    return day_path(base, dataset, day)


def land(df: DataFrame, base: str, dataset: str, day: date | str) -> str:
    """Write one day of a dataset as NDJSON, replacing the day; returns its path."""
    path = landing_path(base, dataset, day)
    replace_directory(
        df.sparkSession,
        path,
        lambda staging: df.write.option("ignoreNullFields", "false").json(staging),
    )
    return path


def read_raw(
    spark: SparkSession, base: str, dataset: str, schema: StructType, day: date | str | None = None
) -> DataFrame:
    """NDJSON of one day, or of every day (then with the day as column ``dt``).

    The schema is given, never inferred. A line that is not JSON becomes an all-null row,
    which the required-column gate rejects later.
    """
    if day is not None:
        return spark.read.schema(schema).json(landing_path(base, dataset, day))
    with_day = StructType([*schema.fields, StructField("dt", DateType())])
    return spark.read.schema(with_day).json(f"{base.rstrip('/')}/{dataset}")
