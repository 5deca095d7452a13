from __future__ import annotations

from datetime import UTC, date, datetime, timedelta, timezone
from unittest.mock import MagicMock

import pytest

from gridmargin import daily
from gridmargin.plans.views import load_mart, register_views
from gridmargin.schemas import DATASETS, DEMAND

DAY = date(2026, 8, 8)


def test_run_date_is_yesterday_in_utc():
    assert daily.resolve_run_date(datetime(2026, 8, 9, 0, 5, tzinfo=UTC)) == DAY
    late = datetime(2026, 8, 9, 20, 0, tzinfo=timezone(timedelta(hours=-5)))  # already the 10th in UTC
    assert daily.resolve_run_date(late) == date(2026, 8, 9)
    assert (datetime.now(UTC).date() - daily.resolve_run_date()).days in (1, 2)


def test_hour_window():
    assert daily.hour_window(DAY) == ("2026-08-08T00", "2026-08-08T23")


def bulk(spark):
    """Two days of the bulk feed, with types that belong to no dataset."""
    hours = [f"{d}T{h:02d}" for d in ("2026-08-08", "2026-08-09") for h in range(24)]
    region = spark.createDataFrame(
        [(h, r, t, v, "megawatthours") for h in hours for r in ("A", "B") for t, v in (("D", "100"), ("TI", "-5"), ("NG", "1"))],
        "period string, respondent string, type string, value string, `value-units` string",
    )
    fuel = spark.createDataFrame(
        [(h, r, f, "60", "megawatthours") for h in hours for r in ("A", "B") for f in ("NG", "WND")],
        "period string, respondent string, fueltype string, value string, `value-units` string",
    )
    return {"demand": region, "interchange": region, "generation_by_fuel": fuel}


def test_a_day_end_to_end(spark, tmp_path):
    base = str(tmp_path)
    report = daily.run_day(spark, base, DAY, bulk(spark), {"respondent": ["A"]})
    assert report.ok and report.stages == ["land", "curate", "load", "model"]
    counts = {d.table: spark.table(d.table).count() for d in DATASETS.values()}
    assert counts == {"raw_demand": 24, "raw_interchange": 24, "raw_generation_by_fuel": 48}
    mart = load_mart(spark, "mart_grid_reliability")
    assert mart.count() == 24
    row = mart.orderBy("period").first()
    assert (row.total_generation_mwh, row.net_available_generation_mwh, row.grid_status) == (120.0, 125.0, "surplus")
    assert row.report_date == DAY
    assert {q.table for q in report.quality} >= {"raw_demand", "stg_demand", "mart_grid_reliability"}
    assert not any(q.failures for q in report.quality)

    # The same day again changes nothing, the next day adds to it.
    assert daily.run_day(spark, base, DAY, bulk(spark), {"respondent": ["A"]}).ok
    assert daily.run_day(spark, base, DAY + timedelta(days=1), bulk(spark), {"respondent": ["A"]}).ok
    assert load_mart(spark, "mart_grid_reliability").count() == 48
    assert load_mart(spark, "mart_demand_vs_generation", cached=True).count() == 96


def test_several_respondents_with_their_own_totals(spark, tmp_path):
    daily.run_day(spark, str(tmp_path), DAY, bulk(spark), total_keys=("period", "respondent"))
    totals = load_mart(spark, "mart_grid_reliability").select("total_generation_mwh")
    assert [r[0] for r in totals.collect()] == [120.0] * 48


def test_a_rejected_dataset_is_skipped_and_ends_the_run(spark, tmp_path):
    sources = bulk(spark)
    broken = sources["interchange"].selectExpr("period", "respondent", "type", "'x' as value", "`value-units`")
    report = daily.run_day(spark, str(tmp_path), DAY, {**sources, "interchange": broken})
    assert (report.stages, report.failed_stage, report.failed) == (["land"], "curate", ["interchange"])
    assert sorted(p.name for p in (tmp_path / "curated").iterdir() if any(p.iterdir())) == [
        "demand", "generation_by_fuel",
    ]
    assert not (tmp_path / "warehouse").exists()


def test_an_empty_day_fails(spark, tmp_path):
    report = daily.run_day(spark, str(tmp_path), date(2026, 1, 1), bulk(spark))
    assert report.failed_stage == "curate" and report.failed == list(DATASETS)


def test_missing_landing_fails_every_dataset(spark, tmp_path):
    assert daily.run(spark, str(tmp_path / "l"), str(tmp_path / "c"), DAY) == list(DATASETS)


def test_unexpected_errors_are_isolated_too(monkeypatch):
    done = []

    def step(dataset):
        if dataset is DEMAND:
            raise RuntimeError("read timed out")
        done.append(dataset.name)

    assert daily._each_dataset(step, "step") == ["demand"]
    assert sorted(done) == ["generation_by_fuel", "interchange"]


class TestMain:
    @pytest.fixture
    def session(self, monkeypatch):
        session = MagicMock()
        monkeypatch.setattr(daily, "get_session", MagicMock(return_value=session))
        return session

    def test_success(self, session, monkeypatch):
        monkeypatch.setattr(daily, "run_day", MagicMock(return_value=daily.RunReport(DAY)))
        daily.main(["--base", "b", "--date", "2026-08-08"])
        daily.run_day.assert_called_once_with(session, "b", DAY, None, {}, ("period",))
        session.stop.assert_called_once()

    def test_sources_facets_and_totals(self, session, monkeypatch):
        monkeypatch.setattr(daily, "run_day", MagicMock(return_value=daily.RunReport(DAY)))
        sources = [a for name in DATASETS for a in ("--source", f"{name}=/x/{name}")]
        daily.main(["--base", "b", "--date", "2026-08-08", *sources, "--facet", "respondent=A,B", "--per-respondent"])
        *_, given, facets, keys = daily.run_day.call_args.args
        assert set(given) == set(DATASETS) and facets == {"respondent": ["A", "B"]}
        assert keys == ("period", "respondent")
        with pytest.raises(SystemExit):
            daily.main(["--base", "b", "--source", "demand=/x"])

    def test_failure_exits_with_one(self, session, monkeypatch):
        failed = daily.RunReport(DAY, failed_stage="curate", failed=["demand"])
        monkeypatch.setattr(daily, "run_day", MagicMock(return_value=failed))
        with pytest.raises(SystemExit) as stop:
            daily.main(["--base", "b"])
        assert stop.value.code == 1
        session.stop.assert_called_once()

    def test_session_stops_when_the_run_raises(self, session, monkeypatch):
        monkeypatch.setattr(daily, "run_day", MagicMock(side_effect=RuntimeError("x")))
        with pytest.raises(RuntimeError):
            daily.main(["--base", "b"])
        session.stop.assert_called_once()


def test_views_over_an_empty_warehouse(spark, tmp_path):
    frames = register_views(spark, str(tmp_path))
    assert {n for n in frames if n.startswith(("stg_", "mart_"))} <= {t.name for t in spark.catalog.listTables()}
    assert spark.table("mart_grid_reliability").count() == 0
