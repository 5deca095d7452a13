"""The daily run: land, curate, load and model one day.

    python -m gridmargin.daily --base <path> [--date YYYY-MM-DD] [--per-respondent]
        [--source demand=<path> ...] [--facet respondent=A,B ...]
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession

from gridmargin.operators.quality import DataValidationError
from gridmargin.operators.totals import PER_RESPONDENT, POOLED
from gridmargin.plans.stored import MARTS, Places, refresh, stored_report
from gridmargin.plans.views import load_mart, register_views
from gridmargin.schemas import DATASETS, Dataset
from gridmargin.session import get_session
from gridmargin.sources.curated import curate_day
from gridmargin.sources.landing import land, read_raw, select_facets
from gridmargin.sources.storage import has_files
from gridmargin.sources.warehouse import load_day

log = logging.getLogger("gridmargin.daily")


@dataclass
class RunReport:
    """What one daily run did: the stage it stopped in (if any) and the failed datasets."""

    run_date: date
    stages: list[str] = field(default_factory=list)
    failed_stage: str | None = None
    failed: list[str] = field(default_factory=list)
    # (check, table, columns, failures) of every check on sources and models; they report only.
    quality: list[Row] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.failed_stage is None


def resolve_run_date(now: datetime | None = None) -> date:
    """Yesterday in UTC. One run date serves every stage, so reruns can backfill."""
    return ((now or datetime.now(UTC)).astimezone(UTC) - timedelta(days=1)).date()


def hour_window(run_date: date) -> tuple[str, str]:
    """First and last hour of a day in the feed's text form."""
    return f"{run_date}T00", f"{run_date}T23"


def paths(base: str) -> dict[str, str]:
    root = base.rstrip("/")
    return {layer: f"{root}/{layer}" for layer in ("landing", "curated", "warehouse")}


def _each_dataset(step: Callable[[Dataset], object], what: str) -> list[str]:
    """Run a step for every dataset at once; returns the failed names in dataset order.

    The datasets are independent, so their Spark jobs may share the cluster; a failure of
    one does not touch the others.
    """

    def attempt(dataset: Dataset) -> bool:
        try:
            step(dataset)
        except DataValidationError as error:
            log.error("%s %s: rejected: %s", what, dataset.name, error)
        except Exception:
            log.exception("%s %s: failed", what, dataset.name)
        else:
            log.info("%s %s: done", what, dataset.name)
            return True
        return False

    with ThreadPoolExecutor(max_workers=len(DATASETS)) as pool:
        outcomes = list(pool.map(attempt, DATASETS.values()))
    return [name for name, ok in zip(DATASETS, outcomes, strict=True) if not ok]


def land_all(
    sources: dict[str, DataFrame],
    landing: str,
    run_date: date,
    facets: dict[str, list[str]] | None = None,
) -> list[str]:
    """Extract the day from the bulk feed tables (by dataset name) and land it."""
    start, end = hour_window(run_date)

    def step(dataset: Dataset) -> None:
        # The feed's own facets win: a caller can narrow a feed, not replace it by another.
        own = {**(facets or {}), **dataset.facets}
        rows = select_facets(sources[dataset.name], own, start, end)
        land(rows.select(*dataset.raw.names), landing, dataset.name, run_date)

    return _each_dataset(step, "land")


def run(spark: SparkSession, landing: str, curated: str, run_date: date) -> list[str]:
    """Curate all datasets of a day; a rejected one is skipped, the others are written."""

    def step(dataset: Dataset) -> None:
        raw = read_raw(spark, landing, dataset.name, dataset.raw, run_date)
        curate_day(raw, curated, dataset, run_date)

    return _each_dataset(step, "curate")


def load_all(spark: SparkSession, curated: str, warehouse: str, run_date: date) -> list[str]:
    return _each_dataset(
        lambda dataset: load_day(spark, curated, warehouse, dataset, run_date), "load"
    )


def model(
    spark: SparkSession,
    base: str,
    warehouse: str,
    run_date: date,
    total_keys: Sequence[str] = POOLED,
) -> list[Row]:
    """Bring the stored marts up to a day, register all models, and check them.

    Returns the outcome of all checks, merged from the counts of every day; only days that
    share periods with this one are read. A warehouse without counts is taken in whole.
    """
    counted = has_files(spark, Places(base, tuple(total_keys)).counts("marts"), "report_date=*")
    dates = refresh(spark, base, warehouse, [run_date] if counted else None, total_keys)
    log.info("marts replaced for %s", ", ".join(dates))
    frames = register_views(spark, warehouse, total_keys)
    for name in MARTS:
        frames[name] = load_mart(spark, name, base=base, total_keys=total_keys)
        frames[name].createOrReplaceTempView(name)
    checks = stored_report(spark, base, total_keys).collect()
    for check in checks:
        if check.failures:
            log.warning("%s on %s (%s): %d", check.check, check.table, check.columns, check.failures)
    return checks


def run_day(
    spark: SparkSession,
    base: str,
    run_date: date,
    sources: dict[str, DataFrame] | None = None,
    facets: dict[str, list[str]] | None = None,
    total_keys: Sequence[str] = POOLED,
) -> RunReport:
    """Land (if bulk sources are given), curate, load and model one day, in that order.

    A stage with failures ends the run; every dataset of that stage is still attempted. The
    checks of the model stage report and do not fail the run.
    """
    where = paths(base)
    report = RunReport(run_date)

    def build() -> list[str]:
        report.quality = model(spark, base, where["warehouse"], run_date, total_keys)
        return []

    stages: list[tuple[str, Callable[[], list[str]]]] = [
        ("curate", lambda: run(spark, where["landing"], where["curated"], run_date)),
        ("load", lambda: load_all(spark, where["curated"], where["warehouse"], run_date)),
        ("model", build),
    ]
    if sources is not None:
        stages.insert(0, ("land", lambda: land_all(sources, where["landing"], run_date, facets)))
    for name, stage in stages:
        report.failed = stage()
        if report.failed:
            report.failed_stage = name
            break
        report.stages.append(name)
    return report


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--base", required=True, help="root of landing, curated and warehouse")
    parser.add_argument("--date", type=date.fromisoformat, default=None)
    parser.add_argument(
        "--source", action="append", default=[], metavar="DATASET=PATH",
        help="Parquet table to land a dataset from; give one for each dataset, or none",
    )
    parser.add_argument(
        "--facet", action="append", default=[], metavar="NAME=VALUE,VALUE",
        help="land only rows with one of these values",
    )
    parser.add_argument(
        "--per-respondent", action="store_true", help="total generation per respondent, not pooled"
    )
    args = parser.parse_args(argv)
    source_paths = dict(item.split("=", 1) for item in args.source)
    if source_paths and set(source_paths) != set(DATASETS):
        parser.error(f"--source is needed for each of {', '.join(DATASETS)}")
    facets = {name: values.split(",") for name, values in (f.split("=", 1) for f in args.facet)}
    spark = get_session("gridmargin-daily")
    try:
        sources = {name: spark.read.parquet(path) for name, path in source_paths.items()}
        report = run_day(
            spark,
            args.base,
            args.date or resolve_run_date(),
            sources or None,
            facets,
            PER_RESPONDENT if args.per_respondent else POOLED,
        )
    finally:
        spark.stop()
    if not report.ok:
        log.error("%s failed for: %s", report.failed_stage, ", ".join(report.failed))
        sys.exit(1)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
