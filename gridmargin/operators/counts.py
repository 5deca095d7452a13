"""Counting operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls per column; zeros on empty input."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def parse_failure_counts(df: DataFrame, parsed_of: dict[str, str]) -> DataFrame:
    """One row with, per raw column, how many non-null texts have a null parsed column."""
    return df.agg(
        *[
            F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNull()).alias(raw)
            for raw, parsed in parsed_of.items()
        ]
    )


def domain_counts(df: DataFrame, column: str, ordered_domain: Sequence[str]) -> DataFrame:
    """Rows per value of a fixed domain, in its order, with zeros for absent values.

    One aggregation with a counter per value; nulls and values outside the domain drop out.
    """
    counters = df.agg(
        *[F.count_if(F.col(column) == value).alias(value) for value in ordered_domain]
    )
    rows = [
        F.struct(
            F.lit(value).alias(column), F.col(value).alias("count"), F.lit(ord_).alias("ord")
        )
        for ord_, value in enumerate(ordered_domain)
    ]
    return counters.select(F.inline(F.array(*rows)))


def loaded_row_counts(tables: dict[str, DataFrame], dt: str | None = None) -> DataFrame:
    """Rows per table for one loaded day, or for each day if none is given."""
    if dt is None:
        parts = [
            df.groupBy("dt").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), "dt", "rows"
            )
            for name, df in tables.items()
        ]
    else:
        day = F.lit(dt).cast("date")
        parts = [
            df.filter(F.col("dt") == day).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), day.alias("dt"), "rows"
            )
            for name, df in tables.items()
        ]
    return reduce(DataFrame.unionByName, parts)


def rows_per_fuel(raw_generation: DataFrame, dt: str | None = None) -> DataFrame:
    """Rows per fuel type, ordered by fuel, for one day or for all of them."""
    if dt is not None:
        raw_generation = raw_generation.filter(F.col("dt") == F.lit(dt).cast("date"))
    return (
        raw_generation.groupBy("fuel_type")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("fuel_type")
    )
