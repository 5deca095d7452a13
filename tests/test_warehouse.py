from datetime import date, datetime

import pytest

from gridmargin.operators.quality import DataValidationError
from gridmargin.schemas import DEMAND, GENERATION
from gridmargin.sources.curated import curated_path, write_curated
from gridmargin.sources.storage import write_days
from gridmargin.sources.warehouse import (
    load_day,
    load_raw_demand,
    load_raw_generation_by_fuel,
    load_raw_interchange,
    read_warehouse,
)

DAY, OTHER = "2026-08-10", "2026-08-11"


@pytest.fixture
def bases(tmp_path):
    return str(tmp_path / "curated"), str(tmp_path / "warehouse")


def curate(spark, bases, day, hours):
    rows = [("BA0", datetime(2026, 8, 10, h), float(h), "megawatthours", date.fromisoformat(day)) for h in hours]
    write_curated(spark.createDataFrame(rows, DEMAND.curated), bases[0], "demand", day)


def hours(spark, bases, day):
    table = read_warehouse(spark, bases[1], DEMAND)
    return sorted(r.period.hour for r in table.filter(f"dt = date'{day}'").collect())


def test_load_types_and_values(spark, bases):
    curate(spark, bases, DAY, [3])
    assert load_raw_demand(spark, *bases, DAY) == f"raw_demand loaded for dt={DAY}"
    table = read_warehouse(spark, bases[1], DEMAND)
    assert [f.dataType for f in table.schema] == [f.dataType for f in DEMAND.warehouse]
    assert tuple(table.first()) == (
        "BA0", datetime(2026, 8, 10, 3), 3.0, "megawatthours", date(2026, 8, 10), date(2026, 8, 10),
    )


def test_reload_replaces_exactly_one_day(spark, bases):
    curate(spark, bases, DAY, [1, 2, 3])
    curate(spark, bases, OTHER, [5])
    for day in (DAY, OTHER, DAY):
        load_raw_demand(spark, *bases, day)
    assert (hours(spark, bases, DAY), hours(spark, bases, OTHER)) == ([1, 2, 3], [5])
    curate(spark, bases, DAY, [1])
    load_raw_demand(spark, *bases, DAY)
    assert (hours(spark, bases, DAY), hours(spark, bases, OTHER)) == ([1], [5])
    curate(spark, bases, DAY, [])
    load_raw_demand(spark, *bases, date.fromisoformat(DAY))
    assert (hours(spark, bases, DAY), hours(spark, bases, OTHER)) == ([], [5])


def test_day_without_files_clears_the_partition(spark, bases):
    curate(spark, bases, DAY, [1])
    load_raw_demand(spark, *bases, DAY)
    load_raw_demand(spark, bases[0] + "-absent", bases[1], DAY)
    assert hours(spark, bases, DAY) == []


def test_unloaded_table_is_empty(spark, bases):
    table = read_warehouse(spark, bases[1], GENERATION)
    assert table.count() == 0 and table.columns == GENERATION.warehouse.fieldNames()


@pytest.mark.parametrize("load", [load_raw_demand, load_raw_interchange, load_raw_generation_by_fuel])
def test_null_run_date(spark, bases, load):
    with pytest.raises(ValueError, match="run_date"):
        load(spark, *bases, None)


def test_only_parquet_files_are_read(spark, bases, tmp_path):
    curate(spark, bases, DAY, [1])
    (tmp_path / "curated" / "demand" / f"dt={DAY}" / "notes.txt").write_text("not parquet")
    load_raw_demand(spark, *bases, DAY)
    assert hours(spark, bases, DAY) == [1]


def test_bad_cast_aborts_and_keeps_the_old_day(spark, bases):
    curate(spark, bases, DAY, [1])
    load_raw_demand(spark, *bases, DAY)
    spark.sql(
        "select 'BA0' respondent, timestamp'2026-08-10 00:00:00' period, 'abc' value, "
        "'megawatthours' value_units, date'2026-08-10' ingestion_date"
    ).write.mode("overwrite").parquet(curated_path(bases[0], "demand", DAY))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_day(spark, *bases, DEMAND, DAY)
    assert hours(spark, bases, DAY) == [1]


def test_not_null_columns_are_enforced(spark, bases):
    spark.sql(
        "select cast(null as string) respondent, timestamp'2026-08-10 00:00:00' period, 1.0D value, "
        "'megawatthours' value_units, date'2026-08-10' ingestion_date"
    ).write.parquet(curated_path(bases[0], "demand", DAY))
    with pytest.raises(DataValidationError, match="raw_demand.*respondent"):
        load_raw_demand(spark, *bases, DAY)
    assert hours(spark, bases, DAY) == []


def test_many_days_at_once(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "date_add(date'2026-01-01', if(id % 3 = 0, 0, cast(id % 40 as int))) as dt", "id"
    )
    write_days(rows, str(tmp_path / "t"), "dt", "id")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 4000
    assert back.groupBy("dt").count().count() == 40


def test_day_filter_prunes_directories(spark, bases):
    for day in (DAY, OTHER):
        curate(spark, bases, day, [1])
        load_raw_demand(spark, *bases, day)
    table = read_warehouse(spark, bases[1], DEMAND).filter(f"dt = date'{DAY}'")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
