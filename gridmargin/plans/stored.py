"""The marts as tables, kept up by the days that were loaded.

Under a root lie, each with a folder per day and replaced day by day (`sources.versions`):
the marts by ``report_date`` (``marts/<totals>/<name>``), the counts of loaded days by ``dt``
(``state/loaded``), those of the marts by ``report_date`` and repeated keys by day of the period
(``state/<totals>/...``). The counts say which days share periods, so that a loaded day replaces
just the days of the marts that its periods reach, from just the days that share theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from gridmargin.operators.state import (
    COUNTS,
    PERIOD_DAY,
    day_of,
    key_counts,
    merged_report,
    part_counts,
)
from gridmargin.operators.totals import POOLED
from gridmargin.plans.marts import demand_vs_generation, grid_reliability, interchange_balance
from gridmargin.plans.staging import stg_demand, stg_generation_by_fuel, stg_interchange
from gridmargin.plans.views import models
from gridmargin.schemas import DATASETS, DEMAND, GENERATION, INTERCHANGE
from gridmargin.sources.storage import _file_system, write_days
from gridmargin.sources.versions import current_paths, current_version, read_versions, replace_version
from gridmargin.sources.warehouse import read_warehouse

SUPPLY, BALANCE, RELIABILITY = "mart_demand_vs_generation", "mart_interchange_balance", "mart_grid_reliability"
MARTS = (SUPPLY, BALANCE, RELIABILITY)


@dataclass(frozen=True)
class Places:
    """Where the marts and counts of one kind of totals lie."""

    base: str
    total_keys: tuple[str, ...]

    @property
    def totals(self) -> str:
        return "per-" + "-".join(self.total_keys)

    def mart(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/marts/{self.totals}/{name}"

    @property
    def loaded(self) -> str:
        return f"{self.base.rstrip('/')}/state/loaded"

    def counts(self, kind: str) -> str:
        return f"{self.base.rstrip('/')}/state/{self.totals}/{kind}"


def _with(schema: StructType, column: str) -> StructType:
    return StructType([*[f for f in schema.fields if f.name != column], StructField(column, DateType())])


def read_counts(spark: SparkSession, path: str, column: str, days: Iterable[str] | None = None) -> DataFrame:
    return read_versions(spark, path, _with(COUNTS, column), column, days)


def mart_schema(spark: SparkSession, name: str, total_keys: Sequence[str]) -> StructType:
    empty = {d.table: spark.createDataFrame([], d.warehouse) for d in DATASETS.values()}
    return models(empty, total_keys)[name].schema


def load_stored_mart(
    spark: SparkSession,
    base: str,
    name: str,
    total_keys: Sequence[str] = POOLED,
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """A stored mart by name, in any session; ``days`` reads those report dates only."""
    schema = mart_schema(spark, name, total_keys)
    path = Places(base, tuple(total_keys)).mart(name)
    stored = read_versions(spark, path, _with(schema, "report_date"), "report_date", days)
    return stored.select(*schema.names)


def replace_parts(df: DataFrame, table: str, column: str, days: Iterable[str], *sort: str) -> None:
    """Replace some days of a table by those of a frame, which is evaluated once for all.

    A day that the frame holds no rows of becomes empty. The days are replaced one after the
    other; readers see each as a whole. If another writer replaces one meanwhile, this one is
    refused with a StaleVersionError.
    """
    spark = df.sparkSession
    fs, root = _file_system(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path
    before = {day: current_version(spark, f"{table}/{column}={day}") for day in days}
    if not before:
        return
    staging = path(root, f"_staging-{uuid.uuid4().hex}")
    try:
        chosen = df.filter(F.col(column).isin([date.fromisoformat(d) for d in before]))
        write_days(chosen, staging.toString(), column, *sort)
        for day, version in sorted(before.items()):

            def move(target: str, day: str = day) -> None:
                rows = path(staging, f"{column}={day}")
                moved = fs.rename(rows, path(target)) if fs.exists(rows) else fs.mkdirs(path(target))
                if not moved:
                    raise OSError(f"could not move the rows of {day} to {target}")

            replace_version(spark, f"{table}/{column}={day}", move, based_on=version)
    finally:
        fs.delete(staging, True)


def _sources(spark: SparkSession, warehouse: str, days: dict[str, Iterable[str]] | None) -> dict[str, DataFrame]:
    return {
        d.table: read_warehouse(spark, warehouse, d, None if days is None else days[d.table])
        for d in DATASETS.values()
    }


def _staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_demand": stg_demand(raw[DEMAND.table]),
        "stg_interchange": stg_interchange(raw[INTERCHANGE.table]),
        "stg_generation_by_fuel": stg_generation_by_fuel(raw[GENERATION.table]),
    }


def _days_of(counts: DataFrame) -> dict[str, dict[str, set[str]]]:
    """Days of the period by table and loaded day: a few rows for each day ever loaded."""
    found: dict[str, dict[str, set[str]]] = {d.table: {} for d in DATASETS.values()}
    for r in counts.filter(F.col("check") == PERIOD_DAY).select("table", "dt", "columns").collect():
        if r.table in found:
            found[r.table].setdefault(str(r.dt), set()).add(r.columns)
    return found


def _sharing(days: dict[str, set[str]], periods: set[str]) -> set[str]:
    return {day for day, own in days.items() if own & periods}


def refresh(
    spark: SparkSession,
    base: str,
    warehouse: str,
    days: Iterable[date | str] | None = None,
    total_keys: Sequence[str] = POOLED,
) -> list[str]:
    """Bring marts and counts up to some loaded days (all there are, if none are given).

    Returns the report dates that were replaced. Only warehouse days that share a period with
    these are read. Where keys repeat, the marts take the form whose hot keys can be split.
    """
    places = Places(base, tuple(total_keys))
    everything = days is None
    if everything:
        known = read_counts(spark, places.loaded, "dt").select("dt").distinct().collect()
        loaded = {
            day for d in DATASETS.values() for day in current_paths(spark, f"{warehouse.rstrip('/')}/{d.table}")
        } | {str(r.dt) for r in known}
    else:
        loaded = {date.fromisoformat(str(d)).isoformat() for d in days}
    raw = _sources(spark, warehouse, None if everything else {d.table: loaded for d in DATASETS.values()})
    staged = {name: frame.withColumnRenamed("report_date", "dt") for name, frame in _staged(raw).items()}
    before = _days_of(read_counts(spark, places.loaded, "dt", loaded))
    replace_parts(part_counts({**raw, **staged}, "dt", period_days=True), places.loaded, "dt", loaded)

    now = _days_of(read_counts(spark, places.loaded, "dt"))
    touched = {p for table in now for day in loaded for days_ in (before, now) for p in days_[table].get(day, ())}
    supply = now[GENERATION.table]
    marts = _sharing(supply, touched) | loaded
    periods = touched.union(*(supply.get(day, set()) for day in marts))
    # A loaded day takes part even if it holds no rows.
    needed = None if everything else {table: _sharing(own, periods) | loaded for table, own in now.items()}
    raw = _sources(spark, warehouse, needed)
    staged = _staged(raw)
    in_touched = day_of().isin([date.fromisoformat(p) for p in touched])
    of_touched = lambda frame: frame if everything else frame.filter(in_touched)
    # The old counts go where a day of the period has no rows left.
    replace_parts(
        key_counts({name: of_touched(frame) for name, frame in staged.items()}),
        places.counts("source-keys"), "period_day", touched,
    )
    repeated = read_counts(spark, places.counts("source-keys"), "period_day", periods)
    repeats = not repeated.filter("count > 0").isEmpty()

    generation, demand = staged["stg_generation_by_fuel"], staged["stg_demand"]
    replace_parts(
        demand_vs_generation(generation, demand, total_keys, repeats),
        places.mart(SUPPLY), "report_date", marts, "respondent", "period",
    )
    flows = staged["stg_interchange"]
    replace_parts(
        interchange_balance(flows, "report_date"), places.mart(BALANCE), "report_date", loaded, "respondent", "period"
    )
    # The rows per fuel are read back, not derived again.
    built = load_stored_mart(spark, base, SUPPLY, total_keys, marts)
    replace_parts(
        grid_reliability(built, interchange_balance(flows), repeats),
        places.mart(RELIABILITY), "report_date", marts, "respondent", "period",
    )
    _count_marts(spark, places, marts, touched)
    return sorted(marts)


def _count_marts(spark: SparkSession, places: Places, days: set[str], periods: set[str]) -> None:
    """Counts of the replaced days of the marts, and repeats on the days of their periods."""
    frames = {}
    for name in MARTS:
        schema = _with(mart_schema(spark, name, places.total_keys), "report_date")
        frames[name] = read_versions(spark, places.mart(name), schema, "report_date", days)
    replace_parts(part_counts(frames, "report_date"), places.counts("marts"), "report_date", days)
    # All rows of these periods lie on the days read: the balance has those of its own load.
    chosen = {n: f.filter(day_of().isin([date.fromisoformat(p) for p in periods])) for n, f in frames.items()}
    of_flows = _flow_days(spark, places, periods)
    schema = _with(mart_schema(spark, BALANCE, places.total_keys), "report_date")
    flows = read_versions(spark, places.mart(BALANCE), schema, "report_date", of_flows)
    chosen[BALANCE] = flows.filter(day_of().isin([date.fromisoformat(p) for p in periods]))
    replace_parts(key_counts(chosen), places.counts("mart-keys"), "period_day", periods)


def _flow_days(spark: SparkSession, places: Places, periods: set[str]) -> set[str]:
    return _sharing(_days_of(read_counts(spark, places.loaded, "dt"))[INTERCHANGE.table], periods)


def stored_report(spark: SparkSession, base: str, total_keys: Sequence[str] = POOLED) -> DataFrame:
    """What ``quality_report`` gives over warehouse and marts, from the stored counts alone."""
    places = Places(base, tuple(total_keys))
    return merged_report(
        spark,
        [
            read_counts(spark, places.loaded, "dt"),
            read_counts(spark, places.counts("marts"), "report_date"),
            read_counts(spark, places.counts("source-keys"), "period_day"),
            read_counts(spark, places.counts("mart-keys"), "period_day"),
        ],
    )


def stored_latest(spark: SparkSession, base: str, total_keys: Sequence[str] = POOLED) -> DataFrame:
    """The row of the last period from the stored mart, reading the days that hold it only.

    The counts of loaded days tell which ones those are, however many newer ones are empty.
    """
    places = Places(base, tuple(total_keys))
    supply = _days_of(read_counts(spark, places.loaded, "dt"))[GENERATION.table]
    last = max((p for own in supply.values() for p in own), default=None)
    days = _sharing(supply, {last}) if last else set()
    mart = load_stored_mart(spark, base, RELIABILITY, total_keys, days)
    return mart.orderBy(F.desc("period"), "respondent").limit(1)
