"""Built-in column expressions: parsing, classification and exact MWh arithmetic."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# Period format, status bounds (lower bound inclusive, first match wins).
PERIOD_FORMAT = "yyyy-MM-dd'T'HH"
STATUS_BOUNDS = (("surplus", 0.15), ("adequate", 0.05), ("tight", 0.0))

_MWH = "decimal(28,6)"
# Below this magnitude a double tells all multiples of a millionth apart.
_EXACT_BELOW = 9.0e9


def parse_period(text: Column) -> Column:
    """Hour text to timestamp; anything that does not match the format is null."""
    return F.try_to_timestamp(text, F.lit(PERIOD_FORMAT))


def parse_value(text: Column) -> Column:
    """Number text to double; anything else is null."""
    return text.try_cast("double")


def run_date_column(run_date: date | str | Column) -> Column:
    """The run date as a DATE column, from a literal or from a day column."""
    value = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return value.cast("date")


def _parts(mwh: Column) -> tuple[Column, Column, Column]:
    """Whole MWh, the rest in millionths, and whether the two say all there is to a reading."""
    finite = F.when(F.abs(mwh) < F.lit(_EXACT_BELOW), mwh)
    whole = F.floor(finite)
    micro = F.rint((finite - whole) * F.lit(1e6)).cast("bigint")
    lossless = (whole * F.lit(1e6) + micro) / F.lit(1e6) == finite
    return whole, micro, F.coalesce(lossless, F.lit(False))


def exact_sum(mwh: Column, window: WindowSpec | None = None) -> Column:
    """Sum of a double column, free of float noise where its values allow it.

    Whole MWh and millionths are added up apart as bigints. If every reading is told whole by
    these two, their sum is the decimal sum and independent of the order of addition. If some
    reading is finer, very large, infinite or NaN, or a bigint overflows, the result is the
    plain double sum. No reading is left out in either case.
    """
    def over(aggregate: Column) -> Column:
        return aggregate if window is None else aggregate.over(window)

    whole, micro, lossless = _parts(mwh)
    others = over(F.count_if(mwh.isNotNull() & ~lossless))
    exact = over(F.try_sum(whole)).cast("decimal(20,0)") + (
        over(F.try_sum(micro)).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    )
    return F.coalesce(F.when(others == 0, exact.cast("double")), over(F.sum(mwh)))


def exact_difference(a: Column, b: Column) -> Column:
    """a - b as a decimal difference where both allow it, else the difference of doubles."""
    lossless = _parts(a)[2] & _parts(b)[2]
    exact = (a.try_cast(_MWH) - b.try_cast(_MWH)).cast("double")
    return F.when(lossless, exact).otherwise(a - b)


def exact_times(mwh: Column, n: Column) -> Column:
    """A reading n times over, as a decimal product where it allows it, else of doubles."""
    product = (mwh.try_cast("decimal(16,6)") * n.try_cast("decimal(18,0)")).cast("double")
    return F.coalesce(F.when(_parts(mwh)[2], product), mwh * n)


def flow_direction(interchange_mwh: Column) -> Column:
    """Sign of the net interchange; null stays null."""
    return (
        F.when(interchange_mwh > 0, "net_export")
        .when(interchange_mwh < 0, "net_import")
        .when(interchange_mwh == 0, "balanced")
    )


def interchange_defaults(interchange_mwh: Column, direction: Column) -> tuple[Column, Column]:
    """Stand-ins for an hour without interchange, be it unmatched or null."""
    return F.coalesce(interchange_mwh, F.lit(0.0)), F.coalesce(direction, F.lit("no_data"))


def net_available(total_generation_mwh: Column, interchange_mwh: Column) -> Column:
    """Generation left for local demand: exports are positive and leave."""
    return exact_difference(total_generation_mwh, F.coalesce(interchange_mwh, F.lit(0.0)))


def reserve_margin(net_available_mwh: Column, demand_mwh: Column) -> Column:
    """Spare generation as a fraction of demand; null where demand is null or zero."""
    return exact_difference(net_available_mwh, demand_mwh) / F.nullif(demand_mwh, F.lit(0.0))


def grid_status(margin: Column) -> Column:
    """Bucket of a reserve margin; NaN is larger than any bound."""
    status = F.when(margin.isNull(), "unknown")
    for name, lower_bound in STATUS_BOUNDS:
        status = status.when(margin >= lower_bound, name)
    return status.otherwise("deficit")
