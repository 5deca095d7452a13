"""Counts of a table by day, stored beside it and merged instead of counted anew.

Rows are (table, check, columns, count) per part, a day. ``rows``, ``not_null`` and ``value``
counts add up over loaded days. Repeated keys do not, since a key may come on two days; but it
holds its period, so they are counted per day of the period (``period_day``) and add up there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gridmargin.operators.quality import MODEL_NOT_NULL, MODEL_UNIQUE, SOURCE_NOT_NULL

COUNTS = StructType(
    [StructField(c, StringType()) for c in ("table", "check", "columns")] + [StructField("count", LongType())]
)
ROWS, NOT_NULL, VALUE, PERIOD_DAY, UNIQUE = "rows", "not_null", "value", "period_day", "unique_combination"
_CHECKED = {**SOURCE_NOT_NULL, **MODEL_NOT_NULL}
# Columns whose values are counted, by table.
COUNTED_VALUES = {
    "raw_generation_by_fuel": "fuel_type",
    "mart_interchange_balance": "flow_direction",
    "mart_grid_reliability": "grid_status",
}


def day_of(period: str = "period") -> Column:
    return F.to_date(period)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def part_counts(frames: dict[str, DataFrame], part: str, period_days: bool = False) -> DataFrame:
    """Rows, nulls of the checked columns and counted values of every table and part.

    ``part`` names the column of the day, which a frame holds beside its checked columns. With
    ``period_days`` also the rows per day of the period. Each table is aggregated once, by the
    day and the few values counted, with partial sums before the shuffle.
    """
    out = []
    for name, frame in frames.items():
        columns = _CHECKED[name]
        value = COUNTED_VALUES.get(name)
        groups = frame.groupBy(
            F.col(part).alias("part"),
            (F.col(value) if value else F.lit(None).cast("string")).alias("value"),
            day_of().cast("string").alias("period_day"),
        ).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)],
        )
        counters = [(ROWS, F.lit(""), F.col("rows"))]
        counters += [(NOT_NULL, F.lit(c), F.col(f"null_{i}")) for i, c in enumerate(columns)]
        if value:
            counters.append((VALUE, F.col("value"), F.col("rows")))
        if period_days:
            counters.append((PERIOD_DAY, F.col("period_day"), F.col("rows")))
        rows = [
            F.struct(F.lit(check).alias("check"), key.alias("columns"), count.alias("n"))
            for check, key, count in counters
        ]
        out.append(
            groups.select("part", F.inline(F.array(*rows)))
            .filter("columns is not null")
            .groupBy("part", "check", "columns")
            .agg(F.sum("n").alias("count"))
            .select("part", F.lit(name).alias("table"), "check", "columns", "count")
        )
    return _union(out).withColumnRenamed("part", part)


def key_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """How many keys repeat in each model, by the day of the period."""
    out = []
    for name, frame in frames.items():
        keys = MODEL_UNIQUE[name]
        copies = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        out.append(
            copies.groupBy(day_of().alias("period_day"))
            .agg(F.count_if(F.col("copies") > 1).alias("count"))
            .select(
                "period_day",
                F.lit(name).alias("table"),
                F.lit(UNIQUE).alias("check"),
                F.lit(", ".join(keys)).alias("columns"),
                "count",
            )
        )
    return _union(out)


def merged_report(spark: SparkSession, states: Sequence[DataFrame]) -> DataFrame:
    """What ``quality_report`` gives, from the stored counts; zeros where nothing is stored."""
    wanted = [(NOT_NULL, t, c) for t, columns in _CHECKED.items() for c in columns]
    wanted += [(UNIQUE, t, ", ".join(keys)) for t, keys in MODEL_UNIQUE.items()]
    checks = spark.createDataFrame(wanted, "check string, table string, columns string")
    found = (
        _union([s.select("table", "check", "columns", "count") for s in states])
        .filter(F.col("check").isin(NOT_NULL, UNIQUE))
        .groupBy("check", "table", "columns")
        .agg(F.sum("count").alias("failures"))
    )
    return checks.join(found, ["check", "table", "columns"], "left").select(
        "check", "table", "columns", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def merged_domain_counts(state: DataFrame, table: str, ordered_domain: Sequence[str]) -> DataFrame:
    """What ``domain_counts`` gives for the counted column of a table, from the stored counts."""
    column = COUNTED_VALUES[table]
    values = state.filter((F.col("table") == table) & (F.col("check") == VALUE))
    counters = values.agg(
        *[F.coalesce(F.sum(F.when(F.col("columns") == v, F.col("count"))), F.lit(0)).alias(v) for v in ordered_domain]
    )
    rows = [
        F.struct(F.lit(v).alias(column), F.col(v).alias("count"), F.lit(i).alias("ord"))
        for i, v in enumerate(ordered_domain)
    ]
    return counters.select(F.inline(F.array(*rows)))


def merged_row_counts(state: DataFrame, tables: Sequence[str]) -> DataFrame:
    """What ``loaded_row_counts`` gives for days with rows, from the stored counts."""
    return state.filter((F.col("check") == ROWS) & F.col("table").isin(*tables)).select(
        "table", "dt", F.col("count").alias("rows")
    )


def merged_rows_per_fuel(state: DataFrame) -> DataFrame:
    """What ``rows_per_fuel`` gives over all days, from the stored counts."""
    return (
        state.filter((F.col("table") == "raw_generation_by_fuel") & (F.col("check") == VALUE))
        .groupBy(F.col("columns").alias("fuel_type"))
        .agg(F.sum("count").alias("rows"))
        .orderBy("fuel_type")
    )
