from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmargin.operators.joins import join_generation_demand, join_reliability_interchange
from gridmargin.operators.totals import (
    PER_RESPONDENT,
    POOLED,
    hourly_totals,
    reliability_base,
    reliability_base_from_staging,
    with_totals,
)
from gridmargin.plans.marts import (
    demand_vs_generation,
    grid_reliability,
    grid_reliability_from_staging,
    interchange_balance,
    write_mart,
)

GENERATION = (
    "respondent string, fuel_type string, period timestamp_ntz, generation_mwh double, "
    "generation_units string, report_date date"
)
DEMAND = (
    "respondent string, period timestamp_ntz, demand_mwh double, demand_units string, "
    "report_date date"
)
INTERCHANGE = DEMAND.replace("demand", "interchange")
T0, T1, T2 = (datetime(2026, 8, 1, h) for h in range(3))
D1, D2 = date(2026, 8, 1), date(2026, 8, 2)
UNIT = "megawatthours"


def frames(spark, generation, demand, interchange=()):
    return (
        spark.createDataFrame([(*g[:4], UNIT, *g[4:]) for g in generation], GENERATION),
        spark.createDataFrame([(*d, UNIT, D1) for d in demand], DEMAND),
        spark.createDataFrame([(*i, UNIT, D1) for i in interchange], INTERCHANGE),
    )


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# The marts once more, row by row, as a check.


def dec(x):
    return None if x is None else Decimal(repr(x))


def expected(generation, demand, interchange, keys):
    demand_of, interchange_of = defaultdict(list), defaultdict(list)
    for r, p, mwh in demand:
        demand_of[p, r].append(mwh)
    for r, p, mwh in interchange:
        interchange_of[p, r].append(mwh)
    joined = []
    for r, fuel, p, mwh, day in generation:
        matches = demand_of.get((p, r)) if None not in (p, r) else None
        joined += [(r, fuel, p, mwh, day, d) for d in matches or [None]]
    totals = {}
    for r, _, p, mwh, _, _ in joined:
        key = (p,) if keys == POOLED else (p, r)
        if mwh is not None:
            totals[key] = totals.get(key, Decimal(0)) + dec(mwh)
    mart, base = Counter(), set()
    for r, fuel, p, mwh, day, d in joined:
        total = totals.get((p,) if keys == POOLED else (p, r))
        delta = None if total is None or d is None else float(total - dec(d))
        total = None if total is None else float(total)
        mart[r, p, fuel, day, mwh, UNIT, d, UNIT if (p, r) in demand_of and None not in (p, r) else None, total, delta] += 1
        base.add((p, r, day, d, total))
    reliability = Counter()
    for p, r, day, d, total in base:
        for flow in interchange_of.get((p, r)) or [None]:
            mwh = 0.0 if flow is None else flow
            direction = (
                "no_data" if flow is None
                else "net_export" if flow > 0 else "net_import" if flow < 0 else "balanced"
            )
            net = None if total is None else dec(total) - dec(mwh)
            margin = None if net is None or not d else float(net - dec(d)) / d
            status = (
                "unknown" if margin is None else "surplus" if margin >= 0.15
                else "adequate" if margin >= 0.05 else "tight" if margin >= 0 else "deficit"
            )
            reliability[p, r, day, d, total, mwh, direction, None if net is None else float(net), margin, status] += 1
    return mart, reliability


def check(spark, generation, demand, interchange, keys):
    g, d, i = frames(spark, generation, demand, interchange)
    mart, reliability = expected(generation, demand, interchange, keys)
    dvg = demand_vs_generation(g, d, keys)
    assert dvg.columns == [
        "respondent", "period", "fuel_type", "report_date", "generation_mwh", "generation_units",
        "demand_mwh", "demand_units", "total_generation_mwh", "supply_demand_delta_mwh",
    ]
    assert rows(dvg) == mart
    assert rows(with_totals(join_generation_demand(g, d), keys)) == mart
    assert rows(demand_vs_generation(g, d, keys, repeats=True)) == mart
    m3 = grid_reliability_from_staging(g, d, i, keys)
    assert m3.columns == [
        "period", "respondent", "report_date", "demand_mwh", "total_generation_mwh",
        "interchange_mwh", "flow_direction", "net_available_generation_mwh",
        "reserve_margin_pct", "grid_status",
    ]
    assert rows(m3) == reliability
    assert rows(grid_reliability(dvg, interchange_balance(i))) == reliability
    assert rows(grid_reliability_from_staging(g, d, i, keys, repeats=True)) == reliability
    assert rows(reliability_base_from_staging(g, d, keys)) == rows(reliability_base(dvg))


@pytest.mark.parametrize("keys", [POOLED, PER_RESPONDENT])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marts_row_by_row(spark, keys, seed):
    """Random rows with gaps, nulls, zeros, duplicates and several report dates."""
    rng = random.Random(seed)
    hours, names = [T0, T1, T2], ["A", "B", "C"]

    def amount():
        return rng.choice([None, 0.0, round(rng.uniform(-50, 200), 2)])

    generation = [
        (rng.choice(names), rng.choice("xyz"), rng.choice(hours), amount(), rng.choice([D1, D2]))
        for _ in range(60)
    ]
    demand = [(rng.choice(names[:2]), rng.choice(hours), amount()) for _ in range(7)]
    interchange = [(rng.choice(names[1:]), rng.choice(hours), amount()) for _ in range(7)]
    check(spark, generation, demand, interchange, keys)


@pytest.mark.parametrize("keys", [POOLED, PER_RESPONDENT])
def test_hot_hour_and_copies(spark, keys):
    """A third of the generation rows in one hour, a third of the demand rows one copy."""
    generation = [("A", f"f{i}", T0, 0.1, D1) for i in range(300)]
    generation += [(f"R{i}", "x", T1 if i % 2 else T2, 1.5, D1) for i in range(600)]
    demand = [("A", T0, 7.0)] * 20 + [(f"R{i}", T1, 1.0) for i in range(40)]
    interchange = [("A", T0, 1.0)] * 5 + [("R1", T1, -0.5)]
    check(spark, generation, demand, interchange, keys)


def test_sort_merge_joins_give_the_same(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_marts_row_by_row(spark, POOLED, 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rows_with_a_null_key_stay(spark):
    """As in any left join; a null respondent finds no demand but counts in its hour."""
    g, d, i = frames(
        spark, [(None, "x", T0, 1.0, D1), ("A", "x", T0, 2.0, D1)], [(None, T0, 5.0), ("A", T0, 4.0)]
    )
    got = demand_vs_generation(g, d).select("respondent", "demand_mwh", "total_generation_mwh")
    assert rows(got) == Counter([(None, None, 3.0), ("A", 4.0, 3.0)])
    assert grid_reliability_from_staging(g, d, i).filter("respondent is null").count() == 1


def test_total_keys(spark):
    g, d, _ = frames(spark, [("A", "x", T0, 10.0, D1), ("B", "x", T0, 5.0, D1)], [("A", T0, 8.0)])
    assert rows(hourly_totals(g, d)) == Counter([(T0, 15.0)])
    assert rows(hourly_totals(g, d, PER_RESPONDENT)) == Counter([(T0, "A", 10.0), (T0, "B", 5.0)])


def test_hours_with_demand_only_vanish(spark):
    g, d, i = frames(spark, [("A", "x", T0, 10.0, D1)], [("A", T1, 8.0)])
    assert [r.period for r in grid_reliability_from_staging(g, d, i).collect()] == [T0]


def test_zero_margin_is_tight(spark):
    g, d, i = frames(
        spark, [("A", "x", T0, 43.5, D1), ("A", "y", T0, 0.05, D1)], [("A", T0, 28.17)], [("A", T0, 15.38)]
    )
    row = grid_reliability_from_staging(g, d, i).first()
    assert (row.reserve_margin_pct, row.grid_status) == (0.0, "tight")


def test_interchange_defaults_for_unmatched_and_null(spark):
    g, d, i = frames(
        spark, [("A", "x", T0, 9.0, D1), ("A", "x", T1, 9.0, D1)], [], [("A", T1, None)]
    )
    base = reliability_base_from_staging(g, d)
    got = join_reliability_interchange(base, interchange_balance(i))
    assert {(r.interchange_mwh, r.flow_direction, r.net_available_generation_mwh) for r in got.collect()} == {
        (0.0, "no_data", 9.0)
    }


def test_empty_inputs(spark):
    g, d, i = frames(spark, [], [], [])
    assert demand_vs_generation(g, d).count() == 0
    assert grid_reliability_from_staging(g, d, i).count() == 0


def test_stored_mart(spark, tmp_path):
    g, d, i = frames(
        spark, [("A", "x", T0, 9.0, D1), ("A", "x", T1, 9.0, D2)], [("A", T0, 8.0)]
    )
    mart = grid_reliability_from_staging(g, d, i)
    for _ in range(2):
        write_mart(mart, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert rows(back.select(*mart.columns)) == rows(mart)


# The first fixture mapping: four respondents, with known counts.

STATUS = ["surplus", "adequate", "tight", "deficit", "unknown"]
COUNTS = {
    ("0.001", POOLED): [294, 5, 31, 37, 478],
    ("0.001", PER_RESPONDENT): [151, 5, 44, 167, 478],
    ("0.01", POOLED): [2606, 2, 1, 1, 178],
    ("0.01", PER_RESPONDENT): [1294, 76, 41, 1199, 178],
    ("0.1", POOLED): [2730, 0, 0, 0, 150],
    ("0.1", PER_RESPONDENT): [1621, 245, 124, 740, 150],
}


@pytest.mark.parametrize(("sf", "keys"), COUNTS)
def test_known_status_counts(spark, sf, keys):
    events = spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet").select(
        "*",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("period"),
        F.hour("ts").alias("h"),
        F.col("value").cast("decimal(18,2)").alias("v"),
        F.to_date("ts").alias("report_date"),
    )
    kind = F.col("event_type")

    def feed(source, who, amount, name, *extra):
        respondent = F.concat(F.lit("BA"), (F.col(who) % 4).cast("string")).alias("respondent")
        return source.groupBy(respondent, *extra, "period", "report_date").agg(
            F.sum(amount).cast("double").alias(f"{name}_mwh")
        ).withColumn(f"{name}_units", F.lit(UNIT))

    zero = F.lit(0).cast("decimal(18,2)")
    generation = feed(events, "user_id", F.col("v"), "generation", kind.alias("fuel_type"))
    demand = feed(
        events.filter("not (event_id % 4 = 1 and h = 5)"), "event_id",
        F.when((kind == "view") | (F.col("h") == 9), zero).otherwise(F.col("v")), "demand",
    )
    interchange = feed(
        events.filter("user_id % 3 <> 0 and not (user_id % 4 = 2 and h = 7)"), "user_id",
        F.when(kind.isin("click", "purchase") & (F.col("h") != 11), F.col("v"))
        .when((kind == "view") | (F.col("h") == 11), zero).otherwise(-F.col("v")), "interchange",
    )
    mart = grid_reliability_from_staging(generation, demand, interchange, keys)
    counts = {r.grid_status: r["count"] for r in mart.groupBy("grid_status").count().collect()}
    assert [counts.get(s, 0) for s in STATUS] == COUNTS[sf, keys]
