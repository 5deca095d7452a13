"""The left joins of the marts.

Sides with a row per hour and respondent are merged, never broadcast: the planner goes by the
size of the files, in which such rows take a fiftieth of what they take in memory. With unique
keys, as the uniqueness checks confirm them, no hour and respondent has more rows than there are
fuels, so no join key can be hot. Where the checks report repeats, ``repeats=True`` chooses
plans whose oversized partitions AQE can split, at the price of more shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmargin.functions import interchange_defaults, net_available

HOUR = ["period", "respondent"]


def merged(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the data, so that no copy of it goes to every executor."""
    return side.hint("merge")


def left_join(left: DataFrame, right: DataFrame, keys: list[str], repeats: bool = False) -> DataFrame:
    """A left join; with ``repeats`` as inner join and anti join, for a hot key on the right.

    AQE cannot split the right side of a left join, but both sides of an inner join.
    """
    if not repeats:
        return left.join(merged(right), keys, "left")
    matched = left.join(merged(right), keys)
    unmatched = left.join(merged(right.select(*keys).distinct()), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def with_day(df: DataFrame) -> DataFrame:
    """Add the day of the period, an extra join key that follows from the others.

    Rows already placed by hour and respondent do not satisfy a join that has the day as a
    key too. Both sides are shuffled for it, and only then can AQE split them.
    """
    return df.withColumn("day", F.to_date("period"))


def join_generation_demand(
    generation: DataFrame, demand: DataFrame, repeats: bool = False
) -> DataFrame:
    """Generation rows with the demand of their hour and respondent, null where missing."""
    return left_join(
        generation, demand.select(*HOUR, "demand_mwh", "demand_units"), HOUR, repeats
    ).select(
        "respondent",
        "period",
        "fuel_type",
        "report_date",
        "generation_mwh",
        "generation_units",
        "demand_mwh",
        "demand_units",
    )


def join_balance(hours: DataFrame, balance: DataFrame, repeats: bool = False) -> DataFrame:
    """Hourly rows with the interchange of their hour and respondent, defaults filled in."""
    mwh, direction = interchange_defaults(F.col("interchange_mwh"), F.col("flow_direction"))
    flows = balance.select(*HOUR, "interchange_mwh", "flow_direction")
    if repeats:
        joined = left_join(with_day(hours), with_day(flows), [*HOUR, "day"], repeats=True)
    else:
        joined = left_join(hours, flows, HOUR)
    return joined.select(
        *hours.columns, mwh.alias("interchange_mwh"), direction.alias("flow_direction")
    )


def join_reliability_interchange(
    base: DataFrame, balance: DataFrame, repeats: bool = False
) -> DataFrame:
    """Reliability base rows with their interchange and the generation it leaves."""
    net = net_available(F.col("total_generation_mwh"), F.col("interchange_mwh"))
    return join_balance(base, balance, repeats).withColumn(
        "net_available_generation_mwh", net
    )
