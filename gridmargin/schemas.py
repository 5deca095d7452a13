"""Declared schemas of every layer and the description of the three datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _fields(*columns: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in columns])


_TEXT, _NUMBER, _DAY = StringType(), DoubleType(), DateType()
_INSTANT, _LOCAL = TimestampType(), TimestampNTZType()

# Landing layer: the feed delivers every field as text.
RAW_DEMAND_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("period", _TEXT, False),
    ("value", _TEXT, True),
    ("value-units", _TEXT, True),
)
RAW_INTERCHANGE_SCHEMA = RAW_DEMAND_SCHEMA
RAW_GENERATION_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("fueltype", _TEXT, False),
    ("period", _TEXT, False),
    ("value", _TEXT, True),
    ("value-units", _TEXT, True),
)

# Curated layer: typed.
CURATED_DEMAND_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("period", _INSTANT, False),
    ("value", _NUMBER, True),
    ("value_units", _TEXT, True),
    ("ingestion_date", _DAY, False),
)
CURATED_INTERCHANGE_SCHEMA = CURATED_DEMAND_SCHEMA
CURATED_GENERATION_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("fuel_type", _TEXT, False),
    ("period", _INSTANT, False),
    ("value", _NUMBER, True),
    ("value_units", _TEXT, True),
    ("ingestion_date", _DAY, False),
)

# Warehouse layer: period without zone, plus the partition day.
WAREHOUSE_DEMAND_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("period", _LOCAL, False),
    ("value", _NUMBER, True),
    ("value_units", _TEXT, True),
    ("ingestion_date", _DAY, False),
    ("dt", _DAY, False),
)
WAREHOUSE_INTERCHANGE_SCHEMA = WAREHOUSE_DEMAND_SCHEMA
WAREHOUSE_GENERATION_SCHEMA = _fields(
    ("respondent", _TEXT, False),
    ("fuel_type", _TEXT, False),
    ("period", _LOCAL, False),
    ("value", _NUMBER, True),
    ("value_units", _TEXT, True),
    ("ingestion_date", _DAY, False),
    ("dt", _DAY, False),
)


@dataclass(frozen=True)
class Dataset:
    """One of the three hourly feeds and how it looks in each layer."""

    name: str
    label: str  # how validation messages call it
    table: str  # warehouse table
    raw: StructType
    curated: StructType
    warehouse: StructType
    renames: dict[str, str]  # landing column -> curated column
    facets: dict[str, list[str]]  # what selects this feed in the bulk table
    key: tuple[str, ...]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.curated.fields if not f.nullable]

    @property
    def required_in_warehouse(self) -> list[str]:
        return [f.name for f in self.warehouse.fields if not f.nullable]


# Dataset and table names, facet codes.
DEMAND = Dataset(
    "demand", "demand", "raw_demand",
    RAW_DEMAND_SCHEMA, CURATED_DEMAND_SCHEMA, WAREHOUSE_DEMAND_SCHEMA,
    {"value-units": "value_units"}, {"type": ["D"]}, ("respondent", "period"),
)
INTERCHANGE = Dataset(
    "interchange", "interchange", "raw_interchange",
    RAW_INTERCHANGE_SCHEMA, CURATED_INTERCHANGE_SCHEMA, WAREHOUSE_INTERCHANGE_SCHEMA,
    {"value-units": "value_units"}, {"type": ["TI"]}, ("respondent", "period"),
)
GENERATION = Dataset(
    "generation_by_fuel", "generation", "raw_generation_by_fuel",
    RAW_GENERATION_SCHEMA, CURATED_GENERATION_SCHEMA, WAREHOUSE_GENERATION_SCHEMA,
    {"value-units": "value_units", "fueltype": "fuel_type"}, {},
    ("respondent", "fuel_type", "period"),
)
DATASETS: dict[str, Dataset] = {d.name: d for d in (DEMAND, INTERCHANGE, GENERATION)}
