from datetime import date

import pytest
from pyspark.sql.types import StructField, StructType

from gridmargin.operators.quality import (
    DataValidationError,
    EmptyDatasetError,
    validators_no_parse_failures,
    validators_required_columns_not_null,
)
from gridmargin.schemas import DEMAND, GENERATION, INTERCHANGE
from gridmargin.sources.curated import (
    curate_day,
    curated_path,
    transform,
    transform_demand,
    transform_generation,
    transform_interchange,
)

RUN_DATE = "2026-08-08"
CASES = [
    pytest.param(transform_demand, DEMAND, ("BA7", "2026-07-30T05", "-17.25", "MWh"), id="demand"),
    pytest.param(transform_interchange, INTERCHANGE, ("BA3", "2026-07-30T05", "0", "MWh"), id="interchange"),
    pytest.param(transform_generation, GENERATION, ("BA3", "WND", "2026-07-30T05", "8.125", "MWh"), id="generation"),
]


def frame(spark, dataset, *rows):
    nullable = StructType([StructField(f.name, f.dataType, True) for f in dataset.raw])
    return spark.createDataFrame(list(rows), nullable)


def changed(dataset, row, column, value):
    values = list(row)
    values[dataset.raw.fieldNames().index(column)] = value
    return tuple(values)


@pytest.mark.parametrize(("function", "dataset", "row"), CASES)
class TestEveryDataset:
    def test_columns(self, spark, function, dataset, row):
        curated = function(frame(spark, dataset, row), RUN_DATE)
        assert curated.columns == dataset.curated.fieldNames()
        assert [f.dataType for f in curated.schema] == [f.dataType for f in dataset.curated]

    def test_values(self, spark, function, dataset, row):
        got = function(frame(spark, dataset, row), RUN_DATE).first()
        hour = got.period
        assert (hour.year, hour.month, hour.day, hour.hour) == (2026, 7, 30, 5)
        assert got.value == float(row[-2]) and isinstance(got.value, float)
        assert got.value_units == "MWh"
        assert got.ingestion_date == date(2026, 8, 8)

    def test_accepts_a_date(self, spark, function, dataset, row):
        got = function(frame(spark, dataset, row), date(2026, 8, 8)).first()
        assert got.ingestion_date == date(2026, 8, 8)

    def test_bad_period(self, spark, function, dataset, row):
        bad = changed(dataset, row, "period", "not-a-timestamp")
        with pytest.raises(DataValidationError, match="period"):
            function(frame(spark, dataset, bad), RUN_DATE)

    def test_bad_value(self, spark, function, dataset, row):
        bad = changed(dataset, row, "value", "not-a-number")
        with pytest.raises(DataValidationError, match="'value'"):
            function(frame(spark, dataset, bad), RUN_DATE)

    def test_null_value_passes(self, spark, function, dataset, row):
        got = function(frame(spark, dataset, changed(dataset, row, "value", None)), RUN_DATE)
        assert got.first().value is None

    @pytest.mark.parametrize("column", ["respondent", "period"])
    def test_null_required(self, spark, function, dataset, row, column):
        bad = changed(dataset, row, column, None)
        with pytest.raises(DataValidationError, match=column):
            function(frame(spark, dataset, bad), RUN_DATE)

    def test_empty_day(self, spark, function, dataset, row):
        with pytest.raises(EmptyDatasetError, match=dataset.label):
            function(frame(spark, dataset), RUN_DATE)
        assert transform(frame(spark, dataset), dataset, RUN_DATE, allow_empty=True).count() == 0

    def test_single_pass_write(self, spark, function, dataset, row, tmp_path):
        curate_day(frame(spark, dataset, row), str(tmp_path), dataset, RUN_DATE)
        written = spark.read.parquet(curated_path(str(tmp_path), dataset.name, RUN_DATE))
        assert written.collect() == function(frame(spark, dataset, row), RUN_DATE).collect()

    def test_single_pass_write_keeps_the_old_day_on_failure(self, spark, function, dataset, row, tmp_path):
        curate_day(frame(spark, dataset, row), str(tmp_path), dataset, RUN_DATE)
        bad = frame(spark, dataset, row, changed(dataset, row, "value", "x"), changed(dataset, row, "value", "y"))
        with pytest.raises(DataValidationError, match=rf"{dataset.label}.* 2 "):
            curate_day(bad, str(tmp_path), dataset, RUN_DATE)
        with pytest.raises(EmptyDatasetError):
            curate_day(frame(spark, dataset), str(tmp_path), dataset, RUN_DATE)
        path = curated_path(str(tmp_path), dataset.name, RUN_DATE)
        assert spark.read.parquet(path).count() == 1
        assert [p.name for p in (tmp_path / dataset.name).iterdir()] == [f"dt={RUN_DATE}"]


def test_fuel_type(spark):
    row = ("BA3", "WND", "2026-07-30T05", "8.125", "MWh")
    assert transform_generation(frame(spark, GENERATION, row), RUN_DATE).first().fuel_type == "WND"
    with pytest.raises(DataValidationError, match="fuel_type"):
        transform_generation(
            frame(spark, GENERATION, changed(GENERATION, row, "fueltype", None)), RUN_DATE
        )


class TestGates:
    def test_no_raw_text_passes(self, spark):
        df = spark.createDataFrame([(None, None)], "raw string, parsed double")
        validators_no_parse_failures(df, "raw", "parsed", "demand")

    def test_parse_failures_are_counted(self, spark):
        df = spark.createDataFrame([("a", None), ("b", None), ("1", 1.0)], "raw string, parsed double")
        with pytest.raises(DataValidationError, match="demand.* 2 "):
            validators_no_parse_failures(df, "raw", "parsed", "demand")

    def test_nulls_are_counted(self, spark):
        df = spark.createDataFrame([("a",), (None,), (None,)], "respondent string")
        with pytest.raises(DataValidationError, match="demand.*respondent.* 2 "):
            validators_required_columns_not_null(df, ["respondent"], "demand")

    def test_later_columns_are_checked(self, spark):
        df = spark.createDataFrame([("a", None)], "respondent string, period string")
        with pytest.raises(DataValidationError, match="period"):
            validators_required_columns_not_null(df, ["respondent", "period"], "demand")

    def test_clean_columns_pass(self, spark):
        df = spark.createDataFrame([("a", "b")], "respondent string, period string")
        validators_required_columns_not_null(df, ["respondent", "period"], "demand")
