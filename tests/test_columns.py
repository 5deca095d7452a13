import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmargin.functions import (
    exact_sum,
    flow_direction,
    grid_status,
    interchange_defaults,
    net_available,
    parse_period,
    parse_value,
    reserve_margin,
)


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    out = rows.select("i", expression(F.col("x")).alias("y")).orderBy("i")
    return [r.y for r in out.collect()]


def test_period_parse(spark):
    texts = ["2026-08-01T14", "2026-08-01T14:30", "2026-08-01", "2026-8-1T4", "2026-08-01T24", "x", None]
    parsed = column(spark, texts, "string", lambda c: parse_period(c).cast("timestamp_ntz"))
    assert parsed == [datetime(2026, 8, 1, 14)] + [None] * 6


def test_value_parse(spark):
    parsed = column(spark, ["123.4", "", "1,000", " 12.5 ", "1e3", "abc", None], "string", parse_value)
    assert parsed == [123.4, None, None, 12.5, 1000.0, None, None]


def test_status_bounds(spark):
    margins = [None, 0.15, 0.1499, 0.05, 0.0499, 0.0, -0.0001]
    assert column(spark, margins, "double", grid_status) == [
        "unknown", "surplus", "adequate", "adequate", "tight", "tight", "deficit",
    ]


def test_flow_direction(spark):
    assert column(spark, [1.0, -1.0, 0.0, None], "double", flow_direction) == [
        "net_export", "net_import", "balanced", None,
    ]


def test_interchange_defaults(spark):
    rows = spark.createDataFrame([(None, None), (5.0, "net_export")], "m double, d string")
    mwh, direction = interchange_defaults(F.col("m"), F.col("d"))
    assert [tuple(r) for r in rows.select(mwh, direction).collect()] == [
        (0.0, "no_data"), (5.0, "net_export"),
    ]


@pytest.mark.parametrize(
    ("net", "demand", "margin"),
    [
        (115.0, 100.0, 0.15), (5.0, 0.0, None), (5.0, None, None), (None, 5.0, None),
        (5.0, math.nan, math.nan), (math.inf, 5.0, math.inf), (9e15, 4.5e15, 1.0),
        (1.2e-7, 1e-7, (1.2e-7 - 1e-7) / 1e-7),
    ],
)
def test_reserve_margin(spark, net, demand, margin):
    row = spark.createDataFrame([(net, demand)], "n double, d double")
    got = row.select(reserve_margin(F.col("n"), F.col("d"))).first()[0]
    assert got is margin or got == pytest.approx(margin, rel=1e-12, nan_ok=True)


def test_zero_margin_is_exact(spark):
    row = spark.createDataFrame([(43.55, 15.38, 28.17)], "t double, i double, d double")
    net = net_available(F.col("t"), F.col("i"))
    margin = reserve_margin(net, F.col("d"))
    assert row.select(margin.alias("m"), grid_status(margin).alias("s")).first() == (0.0, "tight")
    assert 43.55 - 15.38 - 28.17 < 0  # what plain doubles give


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([100.0, math.nan], math.nan),
        ([math.inf, 1.25, None], math.inf),
        ([9e15, 50.0], 9e15 + 50),
        ([1e-7] * 1000, 1e-4),
        ([8.9e15] * 1100, 8.9e15 * 1100),
        ([0.1234565, 1.0], 1.1234565),
        ([None, None], None),
        ([0.1] * 10, 1.0),
    ],
)
def test_exact_sum_leaves_no_reading_out(spark, values, total):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = rows.agg(exact_sum(F.col("x"))).first()[0]
    assert got == pytest.approx(total, rel=1e-12, nan_ok=True) if total is not None else got is None
    windowed = rows.select(exact_sum(F.col("x"), Window.partitionBy()).alias("s")).first()[0]
    assert windowed is got or windowed == pytest.approx(got, rel=1e-12, nan_ok=True)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.decimals(min_value=-(10**9), max_value=10**9, places=6, allow_nan=False),
        min_size=1, max_size=40,
    )
)
def test_exact_sum_is_the_decimal_sum(spark, amounts):
    rows = spark.createDataFrame([(float(a),) for a in amounts], "x double")
    assert rows.agg(exact_sum(F.col("x"))).first()[0] == float(sum(amounts))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=30))
def test_exact_sum_of_any_doubles(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    size = math.fsum(map(abs, values))
    got = rows.agg(exact_sum(F.col("x"))).first()[0]
    assert got == pytest.approx(math.fsum(values), abs=1e-12 * size)
