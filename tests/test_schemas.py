import pytest
from pyspark.sql.types import DateType, DoubleType, StringType, TimestampNTZType, TimestampType

from gridmargin import schemas
from gridmargin.schemas import DATASETS

PLAIN_RAW = ["respondent", "period", "value", "value-units"]
PLAIN = ["respondent", "period", "value", "value_units", "ingestion_date"]


@pytest.mark.parametrize(
    ("schema", "names"),
    [
        (schemas.RAW_DEMAND_SCHEMA, PLAIN_RAW),
        (schemas.RAW_INTERCHANGE_SCHEMA, PLAIN_RAW),
        (
            schemas.RAW_GENERATION_SCHEMA,
            ["respondent", "fueltype", "period", "value", "value-units"],
        ),
        (schemas.CURATED_DEMAND_SCHEMA, PLAIN),
        (schemas.CURATED_INTERCHANGE_SCHEMA, PLAIN),
        (schemas.CURATED_GENERATION_SCHEMA, ["respondent", "fuel_type", *PLAIN[1:]]),
        (schemas.WAREHOUSE_DEMAND_SCHEMA, [*PLAIN, "dt"]),
        (schemas.WAREHOUSE_INTERCHANGE_SCHEMA, [*PLAIN, "dt"]),
        (schemas.WAREHOUSE_GENERATION_SCHEMA, ["respondent", "fuel_type", *PLAIN[1:], "dt"]),
    ],
)
def test_field_names_in_order(schema, names):
    assert schema.fieldNames() == names


@pytest.mark.parametrize("dataset", DATASETS.values(), ids=DATASETS)
def test_types_and_nullability(dataset):
    assert all(isinstance(f.dataType, StringType) for f in dataset.raw)
    assert [f.name for f in dataset.raw if f.nullable] == ["value", "value-units"]
    for schema, period in ((dataset.curated, TimestampType), (dataset.warehouse, TimestampNTZType)):
        assert isinstance(schema["period"].dataType, period)
        assert isinstance(schema["value"].dataType, DoubleType)
        assert isinstance(schema["ingestion_date"].dataType, DateType)
        assert [f.name for f in schema if f.nullable] == ["value", "value_units"]
    assert isinstance(dataset.warehouse["dt"].dataType, DateType)


def test_required_columns():
    assert DATASETS["demand"].required == ["respondent", "period", "ingestion_date"]
    assert DATASETS["generation_by_fuel"].required == [
        "respondent", "fuel_type", "period", "ingestion_date",
    ]
