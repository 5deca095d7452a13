"""Generation totals per hour, and the reliability base rows built on them.

A window over the fuel rows of all respondents would pull a whole hour into one task. Such totals
are aggregated instead (with partial sums before the shuffle) and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmargin.functions import exact_difference, exact_sum, exact_times
from gridmargin.operators.joins import HOUR, merged, with_day

# What the totals are summed over: an hour of all respondents together, or of each one.
POOLED = ("period",)
PER_RESPONDENT = ("period", "respondent")


def _gathered(generation: DataFrame, demand: DataFrame) -> DataFrame:
    """Supply of each hour, respondent and day beside the distinct demand readings, counted.

    Both inputs are read once and collapse map-side, before anything is shuffled to the join.
    ``share`` is what the rows of an hour add to its total: the join of generation and demand
    repeats a generation row for every demand row, so repeated demand raises the total.
    """
    supply = generation.groupBy(*HOUR, "report_date").agg(
        exact_sum(F.col("generation_mwh")).alias("supply")
    )
    readings = demand.groupBy(*HOUR, "demand_mwh").agg(F.count(F.lit(1)).alias("copies"))
    share = exact_times(F.col("supply"), F.coalesce("copies", F.lit(1)))
    return supply.join(merged(readings), HOUR, "left").withColumn("share", share)


def hourly_totals(
    generation: DataFrame, demand: DataFrame, total_keys: Sequence[str] = POOLED
) -> DataFrame:
    """Generation total per key, as it stands after the join of generation and demand.

    Counting the demand rows gives what that join repeats without running it: both inputs go
    through one aggregation that is combined map-side.
    """
    supply = generation.select(
        *HOUR, "generation_mwh", F.lit(None).cast("int").alias("demand_row")
    )
    # A null key never matches in the join, so it must not count as a match here.
    matches = demand.filter(F.col("period").isNotNull() & F.col("respondent").isNotNull()).select(
        *HOUR, F.lit(None).cast("double").alias("generation_mwh"), F.lit(1).alias("demand_row")
    )
    hours = supply.unionAll(matches).groupBy(*HOUR).agg(
        exact_sum(F.col("generation_mwh")).alias("supply"),
        F.greatest(F.count("demand_row"), F.lit(1)).alias("copies"),
    )
    return hours.groupBy(*total_keys).agg(
        exact_sum(exact_times(F.col("supply"), F.col("copies"))).alias("total_generation_mwh")
    )


def join_totals(
    hours: DataFrame, totals: DataFrame, total_keys: Sequence[str], repeats: bool = False
) -> DataFrame:
    """All rows of ``hours`` with their total."""
    keys, columns = list(total_keys), [*hours.columns, "total_generation_mwh"]
    if holds_hours(total_keys):
        totals = merged(totals)
    if repeats:
        hours, totals, keys = with_day(hours), with_day(totals), [*keys, "day"]
    return hours.join(totals, keys, "left").select(*columns)


def holds_hours(total_keys: Sequence[str]) -> bool:
    """Whether a total covers one hour of one respondent, hence few rows."""
    return set(HOUR) <= set(total_keys)


def with_totals(
    joined: DataFrame,
    total_keys: Sequence[str] = POOLED,
    totals: DataFrame | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Joined rows plus ``total_generation_mwh`` and ``supply_demand_delta_mwh``.

    ``totals`` are those of ``hourly_totals``. Without them the joined rows are summed in a
    window; use that only where a key has few rows, as an hour of one respondent with unique
    keys: the window then needs no further shuffle.
    """
    if totals is None:
        total = exact_sum(F.col("generation_mwh"), Window.partitionBy(*total_keys))
        summed = joined.withColumn("total_generation_mwh", total)
    else:
        summed = join_totals(joined, totals, total_keys, repeats)
    delta = exact_difference(F.col("total_generation_mwh"), F.col("demand_mwh"))
    return summed.withColumn("supply_demand_delta_mwh", delta)


BASE_COLUMNS = ["period", "respondent", "report_date", "demand_mwh", "total_generation_mwh"]


def reliability_base(demand_vs_generation: DataFrame) -> DataFrame:
    """One row per hour and respondent: the fuel rows of the mart collapsed."""
    return demand_vs_generation.select(*BASE_COLUMNS).distinct()


def reliability_base_from_staging(
    generation: DataFrame,
    demand: DataFrame,
    total_keys: Sequence[str] = POOLED,
    repeats: bool = False,
) -> DataFrame:
    """What ``reliability_base`` gives, without building the rows per fuel first.

    With unique keys an hour has one gathered row per respondent, few enough for a window; that
    of a respondent's own hour needs no further shuffle. If keys repeat, an hour may have any
    number of rows, so that totals are aggregated and joined back.
    """
    gathered = _gathered(generation, demand)
    if repeats:
        totals = hourly_totals(generation, demand, total_keys)
        return join_totals(gathered, totals, total_keys, repeats).select(*BASE_COLUMNS)
    total = exact_sum(F.col("share"), Window.partitionBy(*total_keys))
    return gathered.withColumn("total_generation_mwh", total).select(*BASE_COLUMNS)
