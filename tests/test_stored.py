"""Stored marts against the direct ones, over days that share periods, repeat keys or hold nothing."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta


from gridmargin.operators.quality import quality_report
from gridmargin.operators.totals import PER_RESPONDENT, POOLED
from gridmargin.plans.reports import latest
from gridmargin.plans.stored import MARTS, Places, load_stored_mart, read_counts, refresh, stored_latest, stored_report
from gridmargin.plans.views import load_mart, models
from gridmargin.schemas import DATASETS, GENERATION
from gridmargin.sources.versions import replace_version
from gridmargin.sources.warehouse import read_warehouse

FIRST = date(2026, 8, 1)


def load(spark, base, table, day, rows):
    """Rows (respondent, fuel, hours after FIRST, value) as one day of a warehouse table."""
    dataset = next(d for d in DATASETS.values() if d.table == table)
    start = datetime(FIRST.year, FIRST.month, FIRST.day)
    full = [
        (r, *([f] if dataset is GENERATION else []), start + timedelta(hours=h), v, "MWh", day, day)
        for r, f, h, v in rows
    ]
    frame = spark.createDataFrame(full, dataset.warehouse).drop("dt").coalesce(1)
    replace_version(spark, f"{base}/warehouse/{table}/dt={day}", lambda path: frame.write.parquet(path))


def some_rows(rng, day, n, spread=0):
    """Hours of a day and of up to ``spread`` days before it; keys may repeat."""
    return [
        (rng.choice("AB"), rng.choice(["gas", "wind"]), 24 * (day - rng.randint(0, spread)) + rng.randrange(24), rng.choice([None, 1.5, 40.0, 7.25]))
        for _ in range(n)
    ]


def load_days(spark, base, days, seed, spread=0, n=25):
    rng = random.Random(seed)
    for day in days:
        for d in DATASETS.values():
            load(spark, base, d.table, FIRST + timedelta(days=day), some_rows(rng, day, n, spread))


def direct(spark, base, keys):
    raw = {d.table: read_warehouse(spark, f"{base}/warehouse", d) for d in DATASETS.values()}
    return {**raw, **models(raw, keys, repeats=True)}


def rows(frame):
    return sorted(map(str, frame.collect()))


def assert_up_to_date(spark, base, keys, checks=False):
    frames = direct(spark, base, keys)
    session = spark.newSession()  # has no view of the first one
    for name in MARTS:
        stored = load_mart(session, name, base=base, total_keys=keys)
        assert stored.schema.names == frames[name].schema.names
        assert rows(stored) == rows(frames[name]), name
    if not checks:
        return
    report = stored_report(session, base, keys)
    assert report.columns == ["check", "table", "columns", "failures"]
    assert rows(report) == rows(quality_report(frames).select(*report.columns))


def test_reloads_of_days_that_share_periods(spark, tmp_path):
    base = str(tmp_path)
    load_days(spark, base, range(4), seed=1, spread=1)
    assert refresh(spark, base, f"{base}/warehouse") == [str(FIRST + timedelta(days=d)) for d in range(4)]
    load_days(spark, base, [2], seed=2, spread=1)
    replaced = refresh(spark, base, f"{base}/warehouse", [FIRST + timedelta(days=2)])
    assert set(replaced) <= {str(FIRST + timedelta(days=d)) for d in (1, 2, 3)}
    assert_up_to_date(spark, base, POOLED)
    load_days(spark, base, [1, 4], seed=3, spread=2, n=15)
    for d in DATASETS.values():
        load(spark, base, d.table, FIRST + timedelta(days=3), [])
    refresh(spark, base, f"{base}/warehouse", [FIRST + timedelta(days=d) for d in (1, 3, 4)])
    assert_up_to_date(spark, base, POOLED, checks=True)


def test_totals_of_each_respondent(spark, tmp_path):
    base = str(tmp_path)
    load_days(spark, base, range(2), seed=8, spread=1)
    refresh(spark, base, f"{base}/warehouse", None, PER_RESPONDENT)
    load_days(spark, base, [1], seed=9, spread=1)
    refresh(spark, base, f"{base}/warehouse", [FIRST + timedelta(days=1)], PER_RESPONDENT)
    assert_up_to_date(spark, base, PER_RESPONDENT)


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_reload_leaves_other_days_alone_and_reads_one_day(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    load_days(spark, base, range(3), seed=4)
    refresh(spark, base, f"{base}/warehouse")
    before = {kind: files(tmp_path / kind) for kind in ("marts", "state")}
    load_days(spark, base, [1], seed=5)
    asked = []

    def reading(spark, warehouse, dataset, days=None):
        asked.append(days)
        return read_warehouse(spark, warehouse, dataset, days)

    monkeypatch.setattr("gridmargin.plans.stored.read_warehouse", reading)
    day = str(FIRST + timedelta(days=1))
    assert refresh(spark, base, f"{base}/warehouse", [day]) == [day]
    assert asked and all(set(days) == {day} for days in asked)
    for kind, old in before.items():
        now = files(tmp_path / kind)
        assert {p for p in old if f"={day}/" not in str(p)} == {p for p in now if f"={day}/" not in str(p)}
        assert all(now[p] == t for p, t in old.items() if p in now)
        assert set(now) - set(old)


def test_a_key_that_repeats_on_two_days_is_found(spark, tmp_path):
    base = str(tmp_path)
    days = [FIRST, FIRST + timedelta(days=1), FIRST + timedelta(days=2)]
    for day in days:
        hour = 24 * (day - FIRST).days
        for d in DATASETS.values():
            load(spark, base, d.table, day, [("A", "gas", hour, 5.0)])
    refresh(spark, base, f"{base}/warehouse")
    assert not any(r.failures for r in stored_report(spark, base).collect())
    # The last day brings the first hour of the first one again.
    load(spark, base, "raw_demand", days[2], [("A", "gas", 48, 5.0), ("A", "gas", 0, 6.0)])
    assert refresh(spark, base, f"{base}/warehouse", [days[2]]) == [str(days[0]), str(days[2])]
    failures = {(r.table, r.check): r.failures for r in stored_report(spark, base).collect() if r.failures}
    assert failures == {
        ("stg_demand", "unique_combination"): 1,
        ("mart_demand_vs_generation", "unique_combination"): 1,
        ("mart_grid_reliability", "unique_combination"): 1,
    }
    load(spark, base, "raw_demand", days[2], [("A", "gas", 48, 5.0)])
    refresh(spark, base, f"{base}/warehouse", [days[2]])
    assert not any(r.failures for r in stored_report(spark, base).collect())


def test_the_latest_row_reads_its_day_only(spark, tmp_path):
    base = str(tmp_path)
    load_days(spark, base, range(3), seed=6)
    for d in DATASETS.values():
        load(spark, base, d.table, FIRST + timedelta(days=3), [])  # the newest day is empty
    refresh(spark, base, f"{base}/warehouse")
    frame = stored_latest(spark, base)
    assert rows(frame) == rows(latest(load_stored_mart(spark, base, "mart_grid_reliability")))
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert f"report_date={FIRST + timedelta(days=2)}" in text and "InMemoryFileIndex(1 paths)" in text
    assert stored_latest(spark, str(tmp_path / "none")).count() == 0


def test_the_report_reads_counts_only(spark, tmp_path):
    base = str(tmp_path)
    load_days(spark, base, range(2), seed=7)
    refresh(spark, base, f"{base}/warehouse")
    text = stored_report(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<table:string,check:string,columns:string,count:bigint>" in text
    assert "/state/" in text and "raw_demand/" not in text and "/marts/per" not in text
    counts = read_counts(spark, Places(base, POOLED).loaded, "dt")
    assert {str(r.dt) for r in counts.collect()} == {str(FIRST), str(FIRST + timedelta(days=1))}


def test_an_empty_warehouse(spark, tmp_path):
    base = str(tmp_path)
    assert refresh(spark, base, f"{base}/warehouse") == []
    for name in MARTS:
        assert load_stored_mart(spark, base, name).count() == 0
    report = stored_report(spark, base)
    assert report.count() and not any(r.failures for r in report.collect())
