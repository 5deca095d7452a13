"""One query per operator; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.functions import (
    flow_direction,
    grid_status,
    interchange_defaults,
    parse_period,
    parse_value,
    reserve_margin,
)
from gridmargin.operators import (
    domain_counts,
    hourly_totals,
    join_generation_demand,
    join_reliability_interchange,
    loaded_row_counts,
    null_counts,
    parse_failure_counts,
    reliability_base_from_staging,
    rows_per_fuel,
    unique_combination,
    with_totals,
)
from gridmargin.operators.quality import (
    MODEL_NOT_NULL,
    MODEL_UNIQUE,
    SOURCE_NOT_NULL,
    not_null_report,
    quality_report,
    unique_report,
)
from gridmargin.operators.totals import PER_RESPONDENT, POOLED
from gridmargin.operators.state import (
    merged_domain_counts,
    merged_row_counts,
    merged_rows_per_fuel,
)
from gridmargin.plans import reports, stored
from gridmargin.plans.marts import demand_vs_generation, grid_reliability_from_staging
from gridmargin.plans.staging import stg_demand, stg_generation_by_fuel, stg_interchange
from gridmargin.plans.views import load_mart, models
from gridmargin.schemas import DATASETS, DEMAND, GENERATION, INTERCHANGE
from gridmargin.sources.curated import parsed_columns
from gridmargin.sources.landing import extract
from gridmargin.sources.warehouse import warehouse_columns
from workload import fixtures, layers

Query = Callable[[SparkSession, str], DataFrame]

# The extract's facets and window: alternatives within a facet, both ends included.
EXTRACT_RESPONDENTS = ["BA0", "BA1"]
EXTRACT_START, EXTRACT_END = "2024-01-02T00", "2024-01-29T23"

_registry: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
                raise ValueError("the session must run in UTC")
            return function(spark, sf_dir.rstrip("/"))

        _registry[name] = run
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_registry)


def _models(spark: SparkSession, sf_dir: str, keys=POOLED, trade: bool = False):
    return models(layers.raw_tables(spark, sf_dir, trade), keys)


# Landing


@query("raw_scan_roundtrip")
def raw_scan_roundtrip(spark, sf_dir):
    return layers.landing(spark, sf_dir, GENERATION.name)


def _extract(spark, sf_dir, dataset):
    bulk = layers.bulk(spark, sf_dir, "fuel" if dataset is GENERATION else "region")
    facets = {"respondent": EXTRACT_RESPONDENTS, **dataset.facets}
    return extract(bulk, facets, EXTRACT_START, EXTRACT_END)


@query("facet_extract_demand")
def facet_extract_demand(spark, sf_dir):
    return _extract(spark, sf_dir, DEMAND)


@query("facet_extract_interchange")
def facet_extract_interchange(spark, sf_dir):
    return _extract(spark, sf_dir, INTERCHANGE)


@query("facet_extract_generation")
def facet_extract_generation(spark, sf_dir):
    return _extract(spark, sf_dir, GENERATION)


# Curate


def _curate(spark, sf_dir, dataset):
    parsed = parsed_columns(layers.landing(spark, sf_dir, dataset.name), dataset, F.col("dt"))
    return parsed.select(*dataset.curated.names).withColumn(
        "period", F.col("period").cast("timestamp_ntz")
    )


@query("curate_demand")
def curate_demand(spark, sf_dir):
    return _curate(spark, sf_dir, DEMAND)


@query("curate_interchange")
def curate_interchange(spark, sf_dir):
    return _curate(spark, sf_dir, INTERCHANGE)


@query("curate_generation")
def curate_generation(spark, sf_dir):
    return _curate(spark, sf_dir, GENERATION)


@query("parse_period")
def parse_period_query(spark, sf_dir):
    texts = fixtures.malformed_texts(spark, sf_dir)
    return texts.select(
        "event_id",
        "period_text",
        parse_period(F.col("period_text")).cast("timestamp_ntz").alias("period"),
    )


@query("parse_value")
def parse_value_query(spark, sf_dir):
    texts = fixtures.malformed_texts(spark, sf_dir)
    return texts.select("event_id", "value_text", parse_value(F.col("value_text")).alias("value"))


@query("null_counts")
def null_counts_query(spark, sf_dir):
    parsed = parsed_columns(
        layers.landing(spark, sf_dir, GENERATION.name), GENERATION, F.col("dt")
    )
    return null_counts(parsed, GENERATION.curated.names)


@query("parse_failure_counts")
def parse_failure_counts_query(spark, sf_dir):
    parsed = fixtures.malformed_texts(spark, sf_dir).select(
        "period_text",
        "value_text",
        parse_period(F.col("period_text")).alias("period"),
        parse_value(F.col("value_text")).alias("value"),
    )
    return parse_failure_counts(parsed, {"period_text": "period", "value_text": "value"})


# Warehouse


def _load(spark, sf_dir, dataset):
    curated = layers.curated(spark, sf_dir, dataset.name)
    return warehouse_columns(curated, dataset, F.col("dt"))


@query("load_raw_demand")
def load_raw_demand(spark, sf_dir):
    return _load(spark, sf_dir, DEMAND)


@query("load_raw_interchange")
def load_raw_interchange(spark, sf_dir):
    return _load(spark, sf_dir, INTERCHANGE)


@query("load_raw_generation")
def load_raw_generation(spark, sf_dir):
    return _load(spark, sf_dir, GENERATION)


@query("loaded_row_counts")
def loaded_row_counts_query(spark, sf_dir):
    return loaded_row_counts(layers.raw_tables(spark, sf_dir))


# The day of the one-day forms of the checks after a load.
LOADED_DAY = "2024-01-10"


@query("loaded_row_counts_one_day")
def loaded_row_counts_one_day(spark, sf_dir):
    return loaded_row_counts(layers.raw_tables(spark, sf_dir), LOADED_DAY)


@query("generation_rows_per_fuel_one_day")
def generation_rows_per_fuel_one_day(spark, sf_dir):
    return rows_per_fuel(layers.warehouse(spark, sf_dir, GENERATION.name), LOADED_DAY)


@query("generation_rows_per_fuel")
def generation_rows_per_fuel(spark, sf_dir):
    return rows_per_fuel(layers.warehouse(spark, sf_dir, GENERATION.name))


# Staging


@query("stg_demand")
def stg_demand_query(spark, sf_dir):
    return stg_demand(layers.warehouse(spark, sf_dir, DEMAND.name))


@query("stg_interchange")
def stg_interchange_query(spark, sf_dir):
    return stg_interchange(layers.warehouse(spark, sf_dir, INTERCHANGE.name))


@query("stg_generation_by_fuel")
def stg_generation_by_fuel_query(spark, sf_dir):
    return stg_generation_by_fuel(layers.warehouse(spark, sf_dir, GENERATION.name))


def _staging(spark, sf_dir):
    return stg_generation_by_fuel_query(spark, sf_dir), stg_demand_query(spark, sf_dir)


# Parts of the marts


@query("grid_status_classify")
def grid_status_classify(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    margin = F.when(F.col("event_type") != "error", (k - 50) / 200)
    return events.select("event_id", margin.alias("margin")).withColumn(
        "grid_status", grid_status(F.col("margin"))
    )


@query("reserve_margin")
def reserve_margin_query(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    demand = F.when(F.col("event_type") != "error", k)
    return events.select("event_id", F.col("value").alias("net"), demand.alias("demand")).select(
        "event_id", reserve_margin(F.col("net"), F.col("demand")).alias("margin")
    )


@query("interchange_defaults")
def interchange_defaults_query(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value")
    mwh = (
        F.when(kind == "click", value).when(kind == "signup", -value).when(kind == "view", F.lit(0.0))
    )
    flows = events.select("event_id", mwh.alias("mwh"), flow_direction(mwh).alias("direction"))
    filled, direction = interchange_defaults(F.col("mwh"), F.col("direction"))
    return flows.select(
        "event_id", filled.alias("interchange_mwh"), direction.alias("flow_direction")
    )


@query("join_generation_demand")
def join_generation_demand_query(spark, sf_dir):
    return join_generation_demand(*_staging(spark, sf_dir))


@query("reliability_base_distinct")
def reliability_base_distinct(spark, sf_dir):
    return reliability_base_from_staging(*_staging(spark, sf_dir))


@query("join_reliability_interchange")
def join_reliability_interchange_query(spark, sf_dir):
    base = reliability_base_from_staging(*_staging(spark, sf_dir))
    return join_reliability_interchange(
        base, _models(spark, sf_dir)["mart_interchange_balance"]
    )


@query("total_generation_window")
def total_generation_window(spark, sf_dir):
    return hourly_totals(*_staging(spark, sf_dir))


@query("supply_demand_delta")
def supply_demand_delta(spark, sf_dir):
    generation, demand = _staging(spark, sf_dir)
    joined = join_generation_demand(generation, demand)
    return with_totals(
        joined, PER_RESPONDENT, hourly_totals(generation, demand, PER_RESPONDENT)
    ).select("respondent", "period", "fuel_type", "total_generation_mwh", "supply_demand_delta_mwh")


# Marts


@query("mart_demand_vs_generation")
def mart_demand_vs_generation(spark, sf_dir):
    return _models(spark, sf_dir)["mart_demand_vs_generation"]


@query("mart_demand_vs_generation_per_respondent")
def mart_demand_vs_generation_per_respondent(spark, sf_dir):
    return _models(spark, sf_dir, PER_RESPONDENT)["mart_demand_vs_generation"]


@query("mart_interchange_balance")
def mart_interchange_balance(spark, sf_dir):
    return _models(spark, sf_dir)["mart_interchange_balance"]


@query("mart_grid_reliability")
def mart_grid_reliability(spark, sf_dir):
    return _models(spark, sf_dir)["mart_grid_reliability"]


@query("mart_grid_reliability_per_respondent")
def mart_grid_reliability_per_respondent(spark, sf_dir):
    return _models(spark, sf_dir, PER_RESPONDENT)["mart_grid_reliability"]


@query("mart_demand_vs_generation_trade")
def mart_demand_vs_generation_trade(spark, sf_dir):
    return _models(spark, sf_dir, PER_RESPONDENT, trade=True)["mart_demand_vs_generation"]


@query("mart_grid_reliability_trade")
def mart_grid_reliability_trade(spark, sf_dir):
    return _models(spark, sf_dir, PER_RESPONDENT, trade=True)["mart_grid_reliability"]


def _resent(demand: DataFrame) -> DataFrame:
    """Demand whose non-zero readings were delivered twice, the second time doubled."""
    again = demand.filter(F.col("demand_mwh") > 0)
    return demand.unionByName(again).unionByName(
        again.withColumn("demand_mwh", F.col("demand_mwh") * 2)
    )


@query("mart_demand_vs_generation_resent_demand")
def mart_demand_vs_generation_resent_demand(spark, sf_dir):
    generation, demand = _staging(spark, sf_dir)
    return demand_vs_generation(generation, _resent(demand), repeats=True)


@query("mart_grid_reliability_resent_demand")
def mart_grid_reliability_resent_demand(spark, sf_dir):
    generation, demand = _staging(spark, sf_dir)
    interchange = stg_interchange_query(spark, sf_dir)
    return grid_reliability_from_staging(
        generation, _resent(demand), interchange, repeats=True
    )


def _scaled_reliability(spark, sf_dir, factor, unit):
    """The mart on readings that six decimals can't hold, in rounded units for comparing."""
    scaled = [
        frame.withColumn(name, F.col(name) * F.lit(factor))
        for frame, name in zip(
            (*_staging(spark, sf_dir), stg_interchange_query(spark, sf_dir)),
            ("generation_mwh", "demand_mwh", "interchange_mwh"),
            strict=True,
        )
    ]
    mart = grid_reliability_from_staging(*scaled, PER_RESPONDENT)
    return mart.select(
        "period",
        "respondent",
        "report_date",
        F.round(F.col("demand_mwh") / unit, 6).alias("demand"),
        F.round(F.col("total_generation_mwh") / unit, 6).alias("total_generation"),
        F.round(F.col("net_available_generation_mwh") / unit, 6).alias("net_available"),
        F.round("reserve_margin_pct", 6).alias("reserve_margin_pct"),
    )


@query("mart_grid_reliability_fine_readings")
def mart_grid_reliability_fine_readings(spark, sf_dir):
    return _scaled_reliability(spark, sf_dir, 1 / 7e7, 1e-6)


@query("mart_grid_reliability_large_readings")
def mart_grid_reliability_large_readings(spark, sf_dir):
    return _scaled_reliability(spark, sf_dir, 1e15 / 7, 1e15)


# Reports


@query("latest_reliability")
def latest_reliability(spark, sf_dir):
    frames = _models(spark, sf_dir, PER_RESPONDENT)
    return reports.latest(frames["mart_grid_reliability"], frames["stg_generation_by_fuel"])


@query("latest_kpis")
def latest_kpis(spark, sf_dir):
    return reports.kpis(latest_reliability(spark, sf_dir))


@query("reserve_margin_series")
def reserve_margin_series(spark, sf_dir):
    return reports.reserve_margin_series(mart_grid_reliability_per_respondent(spark, sf_dir))


@query("grid_status_distribution")
def grid_status_distribution(spark, sf_dir):
    return reports.status_distribution(mart_grid_reliability_per_respondent(spark, sf_dir))


@query("generation_mix_series")
def generation_mix_series(spark, sf_dir):
    return reports.generation_mix_series(mart_demand_vs_generation(spark, sf_dir))


@query("demand_series")
def demand_series(spark, sf_dir):
    return reports.demand_series(mart_demand_vs_generation(spark, sf_dir))


@query("delta_series")
def delta_series(spark, sf_dir):
    return reports.delta_series(mart_demand_vs_generation(spark, sf_dir))


@query("interchange_units_label")
def interchange_units_label(spark, sf_dir):
    return reports.units_label(mart_interchange_balance(spark, sf_dir))


@query("interchange_series")
def interchange_series(spark, sf_dir):
    return reports.interchange_series(mart_interchange_balance(spark, sf_dir))


@query("flow_direction_distribution")
def flow_direction_distribution(spark, sf_dir):
    return reports.flow_distribution(mart_interchange_balance(spark, sf_dir))


# Data quality


@query("dq_source_not_null")
def dq_source_not_null(spark, sf_dir):
    return not_null_report(layers.raw_tables(spark, sf_dir), SOURCE_NOT_NULL)


@query("dq_model_not_null")
def dq_model_not_null(spark, sf_dir):
    return not_null_report(_models(spark, sf_dir), MODEL_NOT_NULL)


@query("dq_unique_combination")
def dq_unique_combination(spark, sf_dir):
    return unique_report(_models(spark, sf_dir), MODEL_UNIQUE)


@query("dq_quality_report")
def dq_quality_report(spark, sf_dir):
    raw = layers.raw_tables(spark, sf_dir)
    return quality_report({**raw, **models(raw)})


@query("dq_unique_combination_resent_demand")
def dq_unique_combination_resent_demand(spark, sf_dir):
    return unique_combination(
        _resent(stg_demand_query(spark, sf_dir)), MODEL_UNIQUE["stg_demand"]
    )


# Stored marts and counts, as the daily run leaves them


@query("chain_demand_vs_generation")
def chain_demand_vs_generation(spark, sf_dir):
    return load_mart(spark, "mart_demand_vs_generation", base=layers.chain(spark, sf_dir))


@query("chain_interchange_balance")
def chain_interchange_balance(spark, sf_dir):
    return load_mart(spark, "mart_interchange_balance", base=layers.chain(spark, sf_dir))


@query("chain_grid_reliability")
def chain_grid_reliability(spark, sf_dir):
    return load_mart(spark, "mart_grid_reliability", base=layers.chain(spark, sf_dir))


@query("chain_quality_report")
def chain_quality_report(spark, sf_dir):
    return stored.stored_report(spark, layers.chain(spark, sf_dir))


@query("chain_latest_reliability")
def chain_latest_reliability(spark, sf_dir):
    return stored.stored_latest(spark, layers.chain(spark, sf_dir))


@query("reloaded_demand_vs_generation")
def reloaded_demand_vs_generation(spark, sf_dir):
    return load_mart(spark, "mart_demand_vs_generation", base=layers.reloaded(spark, sf_dir))


@query("reloaded_grid_reliability")
def reloaded_grid_reliability(spark, sf_dir):
    return load_mart(spark, "mart_grid_reliability", base=layers.reloaded(spark, sf_dir))


@query("reloaded_quality_report")
def reloaded_quality_report(spark, sf_dir):
    return stored.stored_report(spark, layers.reloaded(spark, sf_dir))


def _loaded_counts(spark, sf_dir):
    places = stored.Places(layers.reloaded(spark, sf_dir), POOLED)
    return stored.read_counts(spark, places.loaded, "dt")


def _mart_counts(spark, sf_dir):
    places = stored.Places(layers.reloaded(spark, sf_dir), POOLED)
    return stored.read_counts(spark, places.counts("marts"), "report_date")


@query("merged_row_counts")
def merged_row_counts_query(spark, sf_dir):
    return merged_row_counts(_loaded_counts(spark, sf_dir), [d.table for d in DATASETS.values()])


@query("merged_rows_per_fuel")
def merged_rows_per_fuel_query(spark, sf_dir):
    return merged_rows_per_fuel(_loaded_counts(spark, sf_dir))


@query("merged_status_distribution")
def merged_status_distribution(spark, sf_dir):
    return merged_domain_counts(
        _mart_counts(spark, sf_dir), "mart_grid_reliability", reports.STATUS_ORDER
    )


@query("merged_flow_distribution")
def merged_flow_distribution(spark, sf_dir):
    return merged_domain_counts(
        _mart_counts(spark, sf_dir), "mart_interchange_balance", reports.FLOW_ORDER
    )
