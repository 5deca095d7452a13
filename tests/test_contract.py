"""Every registered query against its SQL, and the plans of the main ones."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from gridmargin.operators.totals import PER_RESPONDENT, POOLED, reliability_base_from_staging
from gridmargin.plans.views import models
from workload import fixtures, layers
from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import _models, queries

SF_DIR = "/root/testdata/sf0.001"
NAMES = list(queries())
# The operator keys every one of which needs a query and its SQL.
KEYS = """raw_scan_roundtrip facet_extract_demand facet_extract_interchange facet_extract_generation
load_raw_demand load_raw_interchange load_raw_generation curate_demand curate_interchange
curate_generation parse_period parse_value stg_demand stg_interchange stg_generation_by_fuel
mart_interchange_balance grid_status_classify reserve_margin interchange_defaults
join_generation_demand join_reliability_interchange reliability_base_distinct null_counts
parse_failure_counts grid_status_distribution flow_direction_distribution loaded_row_counts
generation_rows_per_fuel total_generation_window supply_demand_delta mart_demand_vs_generation
mart_grid_reliability latest_reliability latest_kpis reserve_margin_series generation_mix_series
demand_series delta_series interchange_units_label interchange_series dq_source_not_null
dq_model_not_null dq_unique_combination""".split()

DUCKDB_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_key_is_there():
    assert set(KEYS) <= set(NAMES) == set(ORACLE)
    assert set(NAMES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


@pytest.mark.parametrize("name", NAMES)
def test_types_match_sql(spark, connection, name):
    sql = contract.oracle_sql()[name]
    described = connection.execute(f"describe {sql}").fetchall()
    frame = contract.queries()[name](spark, SF_DIR)
    assert {n: DUCKDB_TYPES[t] for n, t in frame.dtypes} == {r[0]: r[1] for r in described}


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[-1] == "grid_status" and frame.count() > 0


# Plans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def scans(df) -> int:
    return plan(df).count("FileScan parquet")


@pytest.mark.parametrize(
    ("mart", "keys", "most_exchanges", "n_scans"),
    [
        ("mart_grid_reliability", PER_RESPONDENT, 5, 3),
        ("mart_grid_reliability", POOLED, 7, 3),
        ("mart_demand_vs_generation", PER_RESPONDENT, 2, 2),
        ("mart_demand_vs_generation", POOLED, 6, 4),
    ],
)
def test_scans_and_exchanges(spark, no_broadcast, mart, keys, most_exchanges, n_scans):
    frame = _models(spark, SF_DIR, keys)[mart]
    assert exchanges(frame) <= most_exchanges and scans(frame) == n_scans


@pytest.mark.parametrize("keys", [POOLED, PER_RESPONDENT])
@pytest.mark.parametrize("mart", ["mart_demand_vs_generation", "mart_grid_reliability"])
def test_period_filter_reaches_every_scan(spark, keys, mart):
    frame = _models(spark, SF_DIR, keys)[mart]
    text = plan(frame.filter("period >= timestamp_ntz'2024-01-05 00:00:00'"))
    found = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(found) >= 2
    assert all("GreaterThanOrEqual(period,2024-01-05T00:00)" in s for s in found)


def test_totals_read_three_columns(spark):
    text = plan(_models(spark, SF_DIR)["mart_demand_vs_generation"])
    assert "ReadSchema: struct<respondent:string,period:timestamp_ntz,value:double>" in text


def test_latest_row_filters_every_scan(spark):
    text = plan(contract.queries()["latest_reliability"](spark, SF_DIR))
    found = [s for s in text.splitlines() if "FileScan parquet" in s and "PushedFilters: [" in s]
    assert sum("EqualTo(period,ScalarSubquery" in s for s in found) == 3


# Growth


@pytest.mark.parametrize("keys", [POOLED, PER_RESPONDENT])
@pytest.mark.parametrize("repeats", [False, True])
def test_rows_per_hour_and_respondent_are_not_broadcast(spark, keys, repeats):
    """Their files are small enough for it at any of the test sizes, the rows need not be."""
    frames = models(layers.raw_tables(spark, SF_DIR), keys, repeats)
    for name in ("mart_demand_vs_generation", "mart_grid_reliability"):
        joins = [line for line in plan(frames[name]).splitlines() if "BroadcastHashJoin" in line]
        assert not [line for line in joins if "respondent" in line], name
    generation, demand = frames["stg_generation_by_fuel"], frames["stg_demand"]
    base = reliability_base_from_staging(generation, demand, keys, repeats)
    joins = [line for line in plan(base).splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in joins if "respondent" in line]


def test_trade_is_joined_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(layers, "_written", {})
    monkeypatch.setattr(fixtures, "trade", lambda *a, trade=fixtures.trade: calls.append(a) or trade(*a))
    stored = layers.raw_tables(spark, SF_DIR, trade=True)
    assert len(calls) == 1
    for name, feed in fixtures.trade_feeds(spark, SF_DIR).items():
        columns = sorted(set(feed.columns) & set(stored[name].columns))
        assert feed.select(columns).exceptAll(stored[name].select(columns)).isEmpty()
        assert feed.count() == stored[name].count() > 0
