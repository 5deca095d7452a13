"""The registered queries as SQL over the given tables."""

from __future__ import annotations

_MWH = "decimal(28,6)"

# The feeds of workload.fixtures.
_EVENT_FEEDS = """
readings as (
  select concat('BA', cast(user_id // 10 as varchar)) as respondent, event_type as fuel_type,
         date_trunc('hour', ts) as period, cast(value as decimal(18,2)) as value,
         cast(json_extract_string(props, '$.k') as decimal(18,2)) as k
  from events),
raw_generation_by_fuel as (
  select respondent, fuel_type, period,
         cast(sum(case when not (fuel_type = 'error' and k < 20) then value end) as double) as value,
         'megawatthours' as value_units,
         cast(period as date) as ingestion_date, cast(period as date) as dt
  from readings group by respondent, fuel_type, period),
raw_demand as (
  select respondent, period,
         cast(sum(case when fuel_type in ('click', 'purchase') then k * 2.5
                       when fuel_type = 'signup' then 0 end) as double) as value,
         'megawatthours' as value_units,
         cast(period as date) as ingestion_date, cast(period as date) as dt
  from readings where fuel_type <> 'error' group by respondent, period),
raw_interchange as (
  select respondent, period,
         cast(sum(case when fuel_type = 'click' then k when fuel_type = 'signup' then -value
                       when fuel_type = 'purchase' then 0 end) as double) as value,
         'megawatthours' as value_units,
         cast(period as date) as ingestion_date, cast(period as date) as dt
  from readings where fuel_type <> 'view' group by respondent, period)"""

_TRADE_FEEDS = """
trade as (
  select concat('N', cast(s_nationkey as varchar)) as seller,
         concat('N', cast(c_nationkey as varchar)) as buyer, l_partkey,
         date_trunc('day', l_shipdate) as period, cast(l_extendedprice as decimal(18,2)) as amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join supplier on l_suppkey = s_suppkey),
raw_generation_by_fuel as (
  select seller as respondent, p_type as fuel_type, period, cast(sum(amount) as double) as value,
         'megawatthours' as value_units,
         cast(date_trunc('month', period) as date) as ingestion_date,
         cast(date_trunc('month', period) as date) as dt
  from trade join part on l_partkey = p_partkey group by seller, p_type, period),
raw_demand as (
  select buyer as respondent, period, cast(sum(amount) as double) as value,
         'megawatthours' as value_units,
         cast(date_trunc('month', period) as date) as ingestion_date,
         cast(date_trunc('month', period) as date) as dt
  from trade group by buyer, period),
raw_interchange as (
  select respondent, period, cast(sum(amount) as double) as value,
         'megawatthours' as value_units,
         cast(date_trunc('month', period) as date) as ingestion_date,
         cast(date_trunc('month', period) as date) as dt
  from (select seller as respondent, period, amount from trade where seller <> buyer
        union all
        select buyer as respondent, period, -amount as amount from trade where seller <> buyer)
  group by respondent, period)"""

_RESENT = """
select * from stg_demand_once
union all select * from stg_demand_once where demand_mwh > 0
union all select respondent, period, demand_mwh * 2, demand_units, report_date
          from stg_demand_once where demand_mwh > 0"""


def _staging(resent: bool) -> str:
    return f"""
stg_demand_once as (
  select respondent, period, value as demand_mwh, value_units as demand_units, dt as report_date
  from raw_demand),
stg_demand as ({_RESENT if resent else "select * from stg_demand_once"}),
stg_interchange as (
  select respondent, period, value as interchange_mwh, value_units as interchange_units,
         dt as report_date
  from raw_interchange),
stg_generation_by_fuel as (
  select respondent, fuel_type, period, value as generation_mwh, value_units as generation_units,
         dt as report_date
  from raw_generation_by_fuel)"""


def _marts(total_keys: str) -> str:
    return f"""
joined as (
  select g.*, d.demand_mwh, d.demand_units
  from stg_generation_by_fuel g
  left join stg_demand d on g.period = d.period and g.respondent = d.respondent),
totalled as (
  select *, sum(cast(generation_mwh as {_MWH})) over (partition by {total_keys}) as total
  from joined),
mart_demand_vs_generation as (
  select respondent, period, fuel_type, report_date, generation_mwh, generation_units,
         demand_mwh, demand_units, cast(total as double) as total_generation_mwh,
         cast(total - cast(demand_mwh as {_MWH}) as double) as supply_demand_delta_mwh
  from totalled),
mart_interchange_balance as (
  select period, respondent, interchange_mwh, interchange_units,
         case when interchange_mwh > 0 then 'net_export' when interchange_mwh < 0 then 'net_import'
              when interchange_mwh = 0 then 'balanced' end as flow_direction
  from stg_interchange),
base as (
  select distinct period, respondent, report_date, demand_mwh, total_generation_mwh
  from mart_demand_vs_generation),
with_interchange as (
  select b.*, coalesce(i.interchange_mwh, 0.0) as interchange_mwh,
         coalesce(i.flow_direction, 'no_data') as flow_direction,
         cast(cast(b.total_generation_mwh as {_MWH})
              - cast(coalesce(i.interchange_mwh, 0.0) as {_MWH}) as double)
           as net_available_generation_mwh
  from base b
  left join mart_interchange_balance i on b.period = i.period and b.respondent = i.respondent),
margins as (
  select *, cast(cast(net_available_generation_mwh as {_MWH}) - cast(demand_mwh as {_MWH}) as double)
            / nullif(demand_mwh, 0) as reserve_margin_pct
  from with_interchange),
mart_grid_reliability as (
  select period, respondent, report_date, demand_mwh, total_generation_mwh, interchange_mwh,
         flow_direction, net_available_generation_mwh, reserve_margin_pct,
         case when reserve_margin_pct is null then 'unknown'
              when reserve_margin_pct >= 0.15 then 'surplus'
              when reserve_margin_pct >= 0.05 then 'adequate'
              when reserve_margin_pct >= 0.0 then 'tight' else 'deficit' end as grid_status
  from margins)"""


def _with(final: str, total_keys: str = "period", trade: bool = False, resent: bool = False) -> str:
    feeds = _TRADE_FEEDS if trade else _EVENT_FEEDS
    return f"with {feeds},{_staging(resent)},{_marts(total_keys)}\n{final}"


def _scaled(factor: str, unit: str) -> str:
    """The reliability mart per respondent in plain doubles, on readings times a factor."""
    return f"""with {_EVENT_FEEDS},{_staging(False)},
hours as (
  select distinct g.period, g.respondent, g.report_date, d.demand_mwh * {factor} as demand,
         sum(g.generation_mwh * {factor}) over (partition by g.period, g.respondent) as total
  from stg_generation_by_fuel g
  left join stg_demand d on g.period = d.period and g.respondent = d.respondent),
flows as (
  select h.*, total - coalesce(i.interchange_mwh * {factor}, 0) as net
  from hours h
  left join stg_interchange i on h.period = i.period and h.respondent = i.respondent)
select period, respondent, report_date, round(demand / {unit}, 6) as demand,
       round(total / {unit}, 6) as total_generation, round(net / {unit}, 6) as net_available,
       round((net - demand) / nullif(demand, 0), 6) as reserve_margin_pct
from flows"""


_OWN = "period, respondent"
_HOUR_TEXT = "strftime(period, '%Y-%m-%dT%H')"
_VALUE_TEXT = "cast(cast(value as decimal(18,2)) as varchar)"

_TEXTS = """
texts as (
  select event_id,
         case event_type when 'view' then strftime(ts, '%Y-%m-%dT%H:%M')
                         when 'error' then strftime(ts, '%Y-%m-%d')
                         when 'signup' then 'not-a-timestamp'
                         else strftime(ts, '%Y-%m-%dT%H') end as period_text,
         case event_type when 'view' then '1,' || v when 'error' then ''
                         when 'signup' then ' ' || v || ' ' when 'purchase' then v || 'e3'
                         else v end as value_text
  from (select *, cast(cast(value as decimal(18,2)) as varchar) as v from events)),
parsed as (
  select *, try_strptime(period_text, '%Y-%m-%dT%H') as period,
         try_cast(value_text as double) as value
  from texts)"""


def _extract(table: str, extra: str) -> str:
    return _with(
        f"""select {_HOUR_TEXT} as period, respondent, {extra}, {_VALUE_TEXT} as value,
       value_units as "value-units"
from {table}
where respondent in ('BA0', 'BA1')
  and {_HOUR_TEXT} between '2024-01-02T00' and '2024-01-29T23'"""
    )


def _curated(table: str, fuel: str = "") -> str:
    return _with(f"select respondent, {fuel} period, value, value_units, ingestion_date from {table}")


def _loaded(table: str) -> str:
    return _with(f"select * from {table}")


def _distribution(table: str, column: str, domain: list[str]) -> str:
    values = ", ".join(f"('{value}', {ord_})" for ord_, value in enumerate(domain))
    return f"""select d.v as {column}, count(t.{column}) as "count", d.ord
from (values {values}) d(v, ord) left join {table} t on t.{column} = d.v
group by d.v, d.ord"""


def _not_null(checks: dict[str, list[str]]) -> str:
    return " union all ".join(
        f"""select '{table}' as "table", '{column}' as "column",
        count(*) filter (where {column} is null) as failures from {table}"""
        for table, columns in checks.items()
        for column in columns
    )


def _unique(checks: dict[str, list[str]]) -> str:
    return " union all ".join(
        f"""select '{table}' as "table", '{", ".join(keys)}' as "columns", count(*) as failures
        from (select 1 from {table} group by {", ".join(keys)} having count(*) > 1)"""
        for table, keys in checks.items()
    )


def _first_per_period(column: str) -> str:
    return f"""(select period, {column},
        row_number() over (partition by period order by respondent, fuel_type) as rn
        from mart_demand_vs_generation) where rn = 1"""


_HOUR = ["period", "respondent"]
_FUEL_HOUR = ["period", "respondent", "fuel_type"]

_SOURCE_NOT_NULL = {
    "raw_demand": ["respondent", "period", "dt"],
    "raw_interchange": ["respondent", "period", "dt"],
    "raw_generation_by_fuel": ["respondent", "period", "fuel_type", "dt"],
}
_MODEL_NOT_NULL = {
    "stg_demand": [*_HOUR, "demand_mwh"],
    "stg_interchange": [*_HOUR, "interchange_mwh"],
    "stg_generation_by_fuel": [*_FUEL_HOUR, "generation_mwh"],
    "mart_demand_vs_generation": [*_FUEL_HOUR, "demand_mwh", "total_generation_mwh"],
    "mart_interchange_balance": [*_HOUR, "interchange_mwh", "flow_direction"],
    "mart_grid_reliability": [*_HOUR, "demand_mwh", "grid_status"],
}
_MODEL_UNIQUE = {
    "stg_demand": _HOUR,
    "stg_interchange": _HOUR,
    "stg_generation_by_fuel": _FUEL_HOUR,
    "mart_demand_vs_generation": _FUEL_HOUR,
    "mart_interchange_balance": _HOUR,
    "mart_grid_reliability": _HOUR,
}

ORACLE: dict[str, str] = {
    "raw_scan_roundtrip": _with(
        f"""select respondent, fuel_type as fueltype, {_HOUR_TEXT} as period,
       {_VALUE_TEXT} as value, value_units as "value-units", dt
from raw_generation_by_fuel"""
    ),
    "facet_extract_demand": _extract("raw_demand", "'D' as type"),
    "facet_extract_interchange": _extract("raw_interchange", "'TI' as type"),
    "facet_extract_generation": _extract("raw_generation_by_fuel", "fuel_type as fueltype"),
    "curate_demand": _curated("raw_demand"),
    "curate_interchange": _curated("raw_interchange"),
    "curate_generation": _curated("raw_generation_by_fuel", "fuel_type,"),
    "parse_period": f"with {_TEXTS} select event_id, period_text, period from parsed",
    "parse_value": f"with {_TEXTS} select event_id, value_text, value from parsed",
    "null_counts": _with(
        "select "
        + ", ".join(
            f"count(*) filter (where {c} is null) as {c}"
            for c in ("respondent", "fuel_type", "period", "value", "value_units", "ingestion_date")
        )
        + " from raw_generation_by_fuel"
    ),
    "parse_failure_counts": f"""with {_TEXTS}
select count(*) filter (where period_text is not null and period is null) as period_text,
       count(*) filter (where value_text is not null and value is null) as value_text
from parsed""",
    "load_raw_demand": _loaded("raw_demand"),
    "load_raw_interchange": _loaded("raw_interchange"),
    "load_raw_generation": _loaded("raw_generation_by_fuel"),
    "loaded_row_counts": _with(
        " union all ".join(
            f"""select '{t}' as "table", dt, count(*) as "rows" from {t} group by dt"""
            for t in ("raw_demand", "raw_interchange", "raw_generation_by_fuel")
        )
    ),
    "generation_rows_per_fuel": _with(
        """select fuel_type, count(*) as "rows" from raw_generation_by_fuel
group by fuel_type order by fuel_type"""
    ),
    "loaded_row_counts_one_day": _with(
        " union all ".join(
            f"""select '{t}' as "table", date '2024-01-10' as dt, count(*) as "rows" from {t}
where dt = date '2024-01-10'"""
            for t in ("raw_demand", "raw_interchange", "raw_generation_by_fuel")
        )
    ),
    "generation_rows_per_fuel_one_day": _with(
        """select fuel_type, count(*) as "rows" from raw_generation_by_fuel
where dt = date '2024-01-10' group by fuel_type order by fuel_type"""
    ),
    "stg_demand": _with("select * from stg_demand"),
    "stg_interchange": _with("select * from stg_interchange"),
    "stg_generation_by_fuel": _with("select * from stg_generation_by_fuel"),
    "grid_status_classify": """
select event_id, margin,
       case when margin is null then 'unknown' when margin >= 0.15 then 'surplus'
            when margin >= 0.05 then 'adequate' when margin >= 0.0 then 'tight'
            else 'deficit' end as grid_status
from (select event_id, case when event_type <> 'error'
        then (cast(json_extract_string(props, '$.k') as double) - 50) / 200 end as margin
      from events)""",
    "reserve_margin": f"""
select event_id, cast(cast(net as {_MWH}) - cast(demand as {_MWH}) as double)
                 / nullif(demand, 0) as margin
from (select event_id, value as net, case when event_type <> 'error'
        then cast(json_extract_string(props, '$.k') as double) end as demand
      from events)""",
    "interchange_defaults": """
select event_id, coalesce(mwh, 0.0) as interchange_mwh,
       coalesce(case when mwh > 0 then 'net_export' when mwh < 0 then 'net_import'
                     when mwh = 0 then 'balanced' end, 'no_data') as flow_direction
from (select event_id, case event_type when 'click' then value when 'signup' then -value
                                       when 'view' then 0.0 end as mwh
      from events)""",
    "join_generation_demand": _with(
        """select respondent, period, fuel_type, report_date, generation_mwh, generation_units,
       demand_mwh, demand_units from joined"""
    ),
    "reliability_base_distinct": _with("select * from base"),
    "join_reliability_interchange": _with("select * from with_interchange"),
    "total_generation_window": _with(
        "select distinct period, cast(total as double) as total_generation_mwh from totalled"
    ),
    "supply_demand_delta": _with(
        """select respondent, period, fuel_type, total_generation_mwh, supply_demand_delta_mwh
from mart_demand_vs_generation""",
        _OWN,
    ),
    "mart_demand_vs_generation": _with("select * from mart_demand_vs_generation"),
    "mart_demand_vs_generation_per_respondent": _with(
        "select * from mart_demand_vs_generation", _OWN
    ),
    "mart_interchange_balance": _with("select * from mart_interchange_balance"),
    "mart_grid_reliability": _with("select * from mart_grid_reliability"),
    "mart_grid_reliability_per_respondent": _with("select * from mart_grid_reliability", _OWN),
    "mart_demand_vs_generation_trade": _with(
        "select * from mart_demand_vs_generation", _OWN, trade=True
    ),
    "mart_grid_reliability_trade": _with("select * from mart_grid_reliability", _OWN, trade=True),
    "mart_demand_vs_generation_resent_demand": _with(
        "select * from mart_demand_vs_generation", resent=True
    ),
    "mart_grid_reliability_fine_readings": _scaled("(1 / 7e7)", "1e-6"),
    "mart_grid_reliability_large_readings": _scaled("(1e15 / 7)", "1e15"),
    "mart_grid_reliability_resent_demand": _with(
        "select * from mart_grid_reliability", resent=True
    ),
    "latest_reliability": _with(
        "select * from mart_grid_reliability order by period desc, respondent limit 1", _OWN
    ),
    "latest_kpis": _with(
        """select period, respondent, p as reserve_margin_percent,
       coalesce(printf('%.1f%%', p), 'nan%') as reserve_margin,
       upper(grid_status[1]) || grid_status[2:] as grid_status,
       coalesce(format('{:,}', cast(round_even(net_available_generation_mwh, 0) as bigint)), 'nan')
         as net_available_generation
from (select *, round_even(reserve_margin_pct * 100, 1) as p
      from mart_grid_reliability order by period desc, respondent limit 1)""",
        _OWN,
    ),
    "reserve_margin_series": _with(
        """select period, respondent, reserve_margin_pct * 100 as reserve_margin_percent,
       cast(13.75 as double) as target_percent from mart_grid_reliability""",
        _OWN,
    ),
    "grid_status_distribution": _with(
        _distribution(
            "mart_grid_reliability", "grid_status",
            ["surplus", "adequate", "tight", "deficit", "unknown"],
        ),
        _OWN,
    ),
    "generation_mix_series": _with(
        "select period, fuel_type, generation_mwh from mart_demand_vs_generation"
    ),
    "demand_series": _with(f"select period, demand_mwh from {_first_per_period('demand_mwh')}"),
    "delta_series": _with(
        f"""select period, supply_demand_delta_mwh,
       case when supply_demand_delta_mwh >= 0 then 'surplus' else 'shortfall' end as sign
from {_first_per_period('supply_demand_delta_mwh')}"""
    ),
    "interchange_units_label": _with(
        """select coalesce((select interchange_units from mart_interchange_balance
                 where interchange_units is not null order by period, respondent limit 1), 'MWh')
         as units"""
    ),
    "interchange_series": _with(
        "select period, respondent, interchange_mwh, flow_direction from mart_interchange_balance"
    ),
    "flow_direction_distribution": _with(
        _distribution(
            "mart_interchange_balance", "flow_direction", ["net_export", "net_import", "balanced"]
        )
    ),
    "dq_source_not_null": _with(
        _not_null(
            _SOURCE_NOT_NULL
        )
    ),
    "dq_model_not_null": _with(
        _not_null(
            _MODEL_NOT_NULL
        )
    ),
    "dq_unique_combination": _with(
        _unique(
            _MODEL_UNIQUE
        )
    ),
    "dq_quality_report": _with(
        f"""select 'not_null' as "check", "table", "column" as "columns", failures from (
{_not_null({**_SOURCE_NOT_NULL, **_MODEL_NOT_NULL})}) union all
select 'unique_combination' as "check", "table", "columns", failures from (
{_unique(_MODEL_UNIQUE)})"""
    ),
    "dq_unique_combination_resent_demand": _with(
        """select period, respondent, count(*) as "count" from stg_demand
group by period, respondent having count(*) > 1""",
        resent=True,
    ),
}

# The stored forms give what the direct ones give.
ORACLE |= {
    "chain_demand_vs_generation": ORACLE["mart_demand_vs_generation"],
    "chain_interchange_balance": ORACLE["mart_interchange_balance"],
    "chain_grid_reliability": ORACLE["mart_grid_reliability"],
    "chain_quality_report": ORACLE["dq_quality_report"],
    "chain_latest_reliability": _with(
        "select * from mart_grid_reliability order by period desc, respondent limit 1"
    ),
    "reloaded_demand_vs_generation": ORACLE["mart_demand_vs_generation"],
    "reloaded_grid_reliability": ORACLE["mart_grid_reliability"],
    "reloaded_quality_report": ORACLE["dq_quality_report"],
    "merged_row_counts": ORACLE["loaded_row_counts"],
    "merged_rows_per_fuel": ORACLE["generation_rows_per_fuel"],
    "merged_status_distribution": _with(
        _distribution(
            "mart_grid_reliability", "grid_status",
            ["surplus", "adequate", "tight", "deficit", "unknown"],
        )
    ),
    "merged_flow_distribution": ORACLE["flow_direction_distribution"],
}
