from __future__ import annotations

from datetime import date, datetime

import pytest

from gridmargin.operators.counts import (
    domain_counts,
    loaded_row_counts,
    null_counts,
    parse_failure_counts,
    rows_per_fuel,
)
from gridmargin.plans import reports

T0, T1 = datetime(2026, 8, 1, 0), datetime(2026, 8, 1, 1)
RELIABILITY = (
    "period timestamp_ntz, respondent string, net_available_generation_mwh double, "
    "reserve_margin_pct double, grid_status string"
)
DVG = (
    "respondent string, period timestamp_ntz, fuel_type string, generation_mwh double, "
    "demand_mwh double, supply_demand_delta_mwh double"
)
BALANCE = (
    "period timestamp_ntz, respondent string, interchange_mwh double, interchange_units string, "
    "flow_direction string"
)


def test_latest_prefers_the_first_respondent(spark):
    df = spark.createDataFrame(
        [(T0, "A", 1.0, 0.1, "adequate"), (T1, "C", 2.0, 0.2, "surplus"), (T1, "B", 3.0, None, "unknown")],
        RELIABILITY,
    )
    assert [tuple(r)[:2] for r in reports.latest(df).collect()] == [(T1, "B")]


def test_latest_with_the_period_looked_up_first(spark):
    df = spark.createDataFrame([(T0, "A", 1.0, 0.1, "adequate"), (T1, "B", 3.0, None, "unknown")], RELIABILITY)
    assert reports.latest(df, df.select("period")).first().respondent == "B"
    assert reports.latest(df.limit(0), df.limit(0).select("period")).count() == 0


@pytest.mark.parametrize(
    ("net", "margin", "status", "texts"),
    [
        (1234567.4, 0.1225, "surplus", ("12.2%", "Surplus", "1,234,567")),
        (0.5, -0.04567, "deficit", ("-4.6%", "Deficit", "0")),
        (1.5, 0.0, "tight", ("0.0%", "Tight", "2")),
        (None, None, "unknown", ("nan%", "Unknown", "nan")),
    ],
)
def test_kpi_texts(spark, net, margin, status, texts):
    row = reports.kpis(spark.createDataFrame([(T0, "A", net, margin, status)], RELIABILITY)).first()
    assert (row.reserve_margin, row.grid_status, row.net_available_generation) == texts


def test_reserve_margin_series(spark):
    df = spark.createDataFrame([(T0, "A", 1.0, 0.25, "surplus")], RELIABILITY)
    assert tuple(reports.reserve_margin_series(df).first()) == (T0, "A", 25.0, 13.75)


def test_status_distribution_is_ordered_and_zero_filled(spark):
    df = spark.createDataFrame(
        [(T0, "A", 1.0, 0.1, s) for s in ("tight", "tight", "deficit", "other", None)], RELIABILITY
    )
    assert [tuple(r) for r in reports.status_distribution(df).orderBy("ord").collect()] == [
        ("surplus", 0, 0), ("adequate", 0, 1), ("tight", 2, 2), ("deficit", 1, 3), ("unknown", 0, 4),
    ]
    assert [r["count"] for r in reports.status_distribution(df.limit(0)).collect()] == [0] * 5


def test_flow_distribution_drops_nulls(spark):
    df = spark.createDataFrame([(T0, "A", 1.0, "u", "net_export"), (T0, "B", None, "u", None)], BALANCE)
    assert {r.flow_direction: r["count"] for r in reports.flow_distribution(df).collect()} == {
        "net_export": 1, "net_import": 0, "balanced": 0,
    }


def test_series_once_per_period(spark):
    df = spark.createDataFrame(
        [
            ("B", T0, "x", 1.0, 9.0, 2.0), ("A", T0, "y", 1.0, 7.0, -1.0), ("A", T0, "x", 1.0, 7.0, -1.0),
            ("A", T1, "x", 1.0, None, None), ("B", T1, "x", 1.0, 5.0, 0.0),
        ],
        DVG,
    )
    assert {tuple(r) for r in reports.demand_series(df).collect()} == {(T0, 7.0), (T1, None)}
    assert {tuple(r) for r in reports.delta_series(df).collect()} == {
        (T0, -1.0, "shortfall"), (T1, None, "shortfall"),
    }
    assert reports.delta_series(df.filter("respondent = 'B'")).filter("sign = 'surplus'").count() == 2
    assert reports.generation_mix_series(df).count() == 5


def test_units_label(spark):
    df = spark.createDataFrame(
        [(T1, "A", 1.0, "late", "net_export"), (T0, "A", 1.0, None, "net_export"), (T0, "B", 1.0, "first", "net_export")],
        BALANCE,
    )
    assert reports.units_label(df).collect() == [("first",)]
    assert reports.units_label(df.filter("interchange_units is null")).collect() == [("MWh",)]
    assert reports.units_label(df.limit(0)).collect() == [("MWh",)]


def test_interchange_series(spark):
    df = spark.createDataFrame([(T0, "A", 1.0, "u", "net_export")], BALANCE)
    assert tuple(reports.interchange_series(df).first()) == (T0, "A", 1.0, "net_export")


def test_counts_on_empty_input_are_zero(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert tuple(null_counts(df, ["a", "b"]).first()) == (0, 0)
    assert tuple(parse_failure_counts(df, {"a": "b"}).first()) == (0,)
    assert [tuple(r) for r in domain_counts(df, "a", ["x"]).collect()] == [("x", 0, 0)]


def test_row_counts(spark):
    day, other = date(2026, 8, 1), date(2026, 8, 2)
    df = spark.createDataFrame([("NG", day), ("NG", day), ("COL", day), ("NG", other)], "fuel_type string, dt date")
    assert [tuple(r) for r in loaded_row_counts({"t": df}, "2026-08-01").collect()] == [("t", day, 3)]
    assert [tuple(r) for r in loaded_row_counts({"t": df}, "2026-08-05").collect()] == [("t", date(2026, 8, 5), 0)]
    assert {tuple(r) for r in loaded_row_counts({"t": df}).collect()} == {("t", day, 3), ("t", other, 1)}
    assert [tuple(r) for r in rows_per_fuel(df, "2026-08-01").collect()] == [("COL", 1), ("NG", 2)]
    assert [tuple(r) for r in rows_per_fuel(df).collect()] == [("COL", 1), ("NG", 3)]
