from __future__ import annotations

from gridmargin.operators.quality import (
    model_checks,
    MODEL_NOT_NULL,
    MODEL_UNIQUE,
    SOURCE_NOT_NULL,
    not_null,
    quality_report,
    unique_combination,
    warehouse_key_repeats,
)
from gridmargin.plans.views import models
from gridmargin.schemas import DATASETS


def test_not_null(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    assert {tuple(r) for r in not_null(df, ["x", "y"]).collect()} == {("x", 1), ("y", 2)}


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "x string, y int")
    assert {tuple(r) for r in unique_combination(df, ["x", "y"]).collect()} == {("a", 1, 2), (None, 3, 2)}


def test_model_checks_on_empty_input_are_zero(spark):
    df = spark.createDataFrame([], "x string, y int")
    assert {tuple(r) for r in model_checks(df, ["y"], ["x"]).collect()} == {
        ("not_null", "y", 0), ("unique_combination", "x", 0),
    }


def raw(spark, name, rows):
    spec = DATASETS[name]
    return spark.sql(f"select * from values {rows} as t({', '.join(spec.warehouse.names)})")


def test_report_over_sources_and_models(spark):
    hour, day = "timestamp_ntz'2026-08-01 00:00:00'", "date'2026-08-01'"
    tables = {
        "raw_demand": raw(spark, "demand", f"('A',{hour},1D,'u',{day},{day}),('A',{hour},1D,'u',{day},{day})"),
        "raw_interchange": raw(spark, "interchange", f"('A',{hour},cast(null as double),'u',{day},{day})"),
        "raw_generation_by_fuel": raw(
            spark, "generation_by_fuel",
            f"('A','x',{hour},1D,'u',{day},{day}),('B','x',{hour},1D,'u',{day},cast(null as date))",
        ),
    }
    report = quality_report({**tables, **models(tables)})
    assert report.columns == ["check", "table", "columns", "failures"]
    found = {tuple(r)[:3]: r.failures for r in report.collect()}
    checks = sum(map(len, SOURCE_NOT_NULL.values())) + sum(map(len, MODEL_NOT_NULL.values()))
    assert len(found) == checks + len(MODEL_UNIQUE)
    assert {k: v for k, v in found.items() if v} == {
        ("not_null", "raw_generation_by_fuel", "dt"): 1,
        ("not_null", "stg_interchange", "interchange_mwh"): 1,
        ("not_null", "mart_demand_vs_generation", "demand_mwh"): 1,
        ("not_null", "mart_interchange_balance", "interchange_mwh"): 1,
        ("not_null", "mart_interchange_balance", "flow_direction"): 1,
        ("not_null", "mart_grid_reliability", "demand_mwh"): 1,
        ("unique_combination", "stg_demand", "period, respondent"): 1,
        ("unique_combination", "mart_demand_vs_generation", "period, respondent, fuel_type"): 1,
    }
    repeats = {r.table: r.failures for r in warehouse_key_repeats(tables).collect()}
    assert repeats == {"raw_demand": 1, "raw_interchange": 0, "raw_generation_by_fuel": 0}
