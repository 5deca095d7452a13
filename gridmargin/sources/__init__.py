"""Reading and writing of the landing, curated and warehouse layers."""

from gridmargin.sources.curated import (
    curate_day,
    curated_path,
    parsed_columns,
    transform,
    transform_demand,
    transform_generation,
    transform_interchange,
    write_curated,
)
from gridmargin.sources.landing import extract, land, landing_path, read_raw
from gridmargin.sources.storage import replace_directory, write_days
from gridmargin.sources.warehouse import (
    load_day,
    load_raw_demand,
    load_raw_generation_by_fuel,
    load_raw_interchange,
    read_warehouse,
    warehouse_columns,
)

__all__ = [
    "curate_day",
    "curated_path",
    "extract",
    "land",
    "landing_path",
    "load_day",
    "load_raw_demand",
    "load_raw_generation_by_fuel",
    "load_raw_interchange",
    "parsed_columns",
    "read_raw",
    "read_warehouse",
    "replace_directory",
    "transform",
    "transform_demand",
    "transform_generation",
    "transform_interchange",
    "warehouse_columns",
    "write_curated",
    "write_days",
]
