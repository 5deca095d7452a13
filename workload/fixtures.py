"""Grid feeds derived from the given tables.

Every event and every line item takes part; respondents grow with the data. The mapping
keeps each branch of the marts alive:

- generation: per ten users, event type (the fuel) and hour, the sum of ``value``; an
  ``error`` event with a low ``k`` is a missing reading (null)
- demand: per ten users and hour 2.5 x ``k`` of clicks and purchases; a signup counts 0, a
  view is a missing reading (null), an hour with errors only has no row
- interchange: clicks export ``k``, signups import ``value``, purchases are balanced, errors
  are missing readings (null), an hour with views only has no row
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNITS = "megawatthours"
_CENTS = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _readings(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("BA"), F.floor(F.col("user_id") / 10).cast("string")).alias("respondent"),
        F.col("event_type").alias("fuel_type"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("period"),
        F.col("value").cast(_CENTS).alias("value"),
        F.get_json_object("props", "$.k").cast(_CENTS).alias("k"),
    )


def _feed(readings: DataFrame, amount: Column, *keys: str, batch: str = "day") -> DataFrame:
    """Sum up a feed; ``dt`` is the first day of the batch (a day or a month) it came with."""
    loaded_on = F.date_trunc(batch, "period").cast("date")
    return (
        readings.groupBy(*keys)
        .agg(F.sum(amount).cast("double").alias("value"))
        .select(
            *keys,
            "value",
            F.lit(UNITS).alias("value_units"),
            loaded_on.alias("ingestion_date"),
            loaded_on.alias("dt"),
        )
    )


def raw_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = (F.col("fuel_type") == "error") & (F.col("k") < 20)
    return _feed(
        _readings(table(spark, sf_dir, "events")),
        F.when(~lost, F.col("value")),
        "respondent", "fuel_type", "period",
    )


def raw_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("fuel_type")
    zero = F.lit(0).cast(_CENTS)
    return _feed(
        _readings(table(spark, sf_dir, "events")).filter(kind != "error"),
        F.when(kind.isin("click", "purchase"), F.col("k") * F.lit(2.5).cast("decimal(2,1)"))
        .when(kind == "signup", zero),
        "respondent", "period",
    )


def raw_interchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("fuel_type")
    zero = F.lit(0).cast(_CENTS)
    return _feed(
        _readings(table(spark, sf_dir, "events")).filter(kind != "view"),
        F.when(kind == "click", F.col("k"))
        .when(kind == "signup", -F.col("value"))
        .when(kind == "purchase", zero),
        "respondent", "period",
    )


RAW_FEEDS = {
    "raw_demand": raw_demand,
    "raw_interchange": raw_interchange,
    "raw_generation_by_fuel": raw_generation,
}


def as_text(raw: DataFrame) -> DataFrame:
    """A feed the way it arrives: text fields under the feed's own column names."""
    renamed = raw.withColumnsRenamed({"value_units": "value-units", "fuel_type": "fueltype"})
    return renamed.withColumns(
        {
            "period": F.date_format("period", "yyyy-MM-dd'T'HH"),
            "value": F.col("value").cast(_CENTS).cast("string"),
        }
    ).drop("ingestion_date")


def bulk_region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand (D), interchange (TI) and a distractor (X) in one long text table."""
    demand = as_text(raw_demand(spark, sf_dir))
    interchange = as_text(raw_interchange(spark, sf_dir))
    typed = [
        frame.select("period", "respondent", F.lit(code).alias("type"), "value", "value-units")
        for code, frame in (("D", demand), ("TI", interchange), ("X", demand))
    ]
    return typed[0].unionByName(typed[1]).unionByName(typed[2])


def bulk_fuel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(raw_generation(spark, sf_dir)).select(
        "period", "respondent", "fueltype", "value", "value-units"
    )


def malformed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour and number texts of every event, well-formed or not by event type."""
    ts, kind, value = F.col("ts"), F.col("event_type"), F.col("value").cast(_CENTS).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "signup", F.lit("not-a-timestamp"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH"))
        .alias("period_text"),
        F.when(kind == "view", F.concat(F.lit("1,"), value))
        .when(kind == "error", F.lit(""))
        .when(kind == "signup", F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == "purchase", F.concat(value, F.lit("e3")))
        .otherwise(value)
        .alias("value_text"),
    )


# Trade between nations, per day and loaded by the month, from the order tables.


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the ship day and the nations of both sides.

    Customers join the orders, which are fewer than the line items; these are shuffled by order
    only, wherever the suppliers are few enough to be broadcast.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    sold = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select(
        "l_orderkey",
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("seller"),
        "l_partkey",
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("period"),
        F.col("l_extendedprice").cast(_CENTS).alias("amount"),
    )
    bought = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("buyer")
    )
    return sold.join(bought, sold.l_orderkey == bought.o_orderkey).select(
        "seller", "buyer", "l_partkey", "period", "amount"
    )


def trade_feeds(
    spark: SparkSession, sf_dir: str, joined: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Generation by part type, demand and net interchange of the nations, per day.

    ``joined`` are the rows of :func:`trade` where they are stored; else each feed joins them anew.
    """
    trade_rows = trade(spark, sf_dir) if joined is None else joined
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("fuel_type"))
    generation = _feed(
        trade_rows.join(parts, trade_rows.l_partkey == parts.p_partkey).select(
            F.col("seller").alias("respondent"), "fuel_type", "period", "amount"
        ),
        F.col("amount"), "respondent", "fuel_type", "period", batch="month",
    )
    demand = _feed(
        trade_rows.select(F.col("buyer").alias("respondent"), "period", "amount"),
        F.col("amount"), "respondent", "period", batch="month",
    )
    across = trade_rows.filter(F.col("seller") != F.col("buyer"))
    flows = across.select(
        F.inline(
            F.array(
                F.struct(F.col("seller").alias("respondent"), "period", "amount"),
                F.struct(
                    F.col("buyer").alias("respondent"), "period", (-F.col("amount")).alias("amount")
                ),
            )
        )
    )
    interchange = _feed(flows, F.col("amount"), "respondent", "period", batch="month")
    return {
        "raw_demand": demand,
        "raw_interchange": interchange,
        "raw_generation_by_fuel": generation,
    }
