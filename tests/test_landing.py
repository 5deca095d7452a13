import json
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridmargin import daily
from gridmargin.operators.quality import DataValidationError
from gridmargin.schemas import DATASETS, DEMAND, RAW_DEMAND_SCHEMA
from gridmargin.session import scratch_dir
from gridmargin.sources.curated import transform_demand
from gridmargin.sources.landing import extract, land, landing_path, read_raw

DAY = "2026-08-08"


def lines(tmp_path, dataset="demand", day=DAY):
    return [
        line
        for part in sorted((tmp_path / dataset / f"dt={day}").glob("part-*"))
        for line in part.read_text().splitlines()
    ]


def test_path():
    assert landing_path("s3://bucket/landing/", "demand", DAY) == f"s3://bucket/landing/demand/dt={DAY}"


def test_one_object_per_line_with_explicit_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string").coalesce(1)
    land(df, str(tmp_path), "demand", DAY)
    assert [json.loads(line) for line in lines(tmp_path)] == [{"a": 1, "b": None}, {"a": 2, "b": "b"}]


def test_rerun_replaces_the_day_only(spark, tmp_path):
    for day, ids in ((DAY, [1, 2]), ("2026-08-09", [3]), (DAY, [4])):
        land(spark.createDataFrame([(i,) for i in ids], "a int"), str(tmp_path), "demand", day)
    assert lines(tmp_path) == ['{"a":4}']
    assert lines(tmp_path, day="2026-08-09") == ['{"a":3}']


def test_no_rows_clear_the_day(spark, tmp_path):
    row = ("BA0", "2026-08-08T00", "1", "megawatthours")
    for rows in ([row], []):
        land(spark.createDataFrame(rows, DEMAND.raw), str(tmp_path), "demand", DAY)
    assert read_raw(spark, str(tmp_path), "demand", RAW_DEMAND_SCHEMA, DAY).count() == 0


def written(tmp_path, text):
    day = tmp_path / "demand" / f"dt={DAY}"
    day.mkdir(parents=True)
    (day / "data.ndjson").write_text(text)
    return str(tmp_path)


def test_lone_newline_is_an_empty_day(spark, tmp_path):
    base = written(tmp_path, "\n")
    assert read_raw(spark, base, "demand", RAW_DEMAND_SCHEMA, DAY).count() == 0


def test_extra_fields_drop_and_missing_ones_are_null(spark, tmp_path):
    base = written(tmp_path, '{"respondent":"BA0","period":"2026-08-08T00","type":"D"}\n')
    raw = read_raw(spark, base, "demand", RAW_DEMAND_SCHEMA, DAY)
    assert raw.columns == RAW_DEMAND_SCHEMA.fieldNames()
    assert tuple(raw.first()) == ("BA0", "2026-08-08T00", None, None)


def test_malformed_line_fails_the_required_gate(spark, tmp_path):
    base = written(tmp_path, "not json\n")
    raw = read_raw(spark, base, "demand", RAW_DEMAND_SCHEMA, DAY)
    assert tuple(raw.first()) == (None,) * 4
    with pytest.raises(DataValidationError, match="respondent"):
        transform_demand(raw, DAY)


def test_all_days_with_dt(spark, tmp_path):
    row = ("BA0", "2026-08-08T00", "1", "megawatthours")
    for day in (DAY, "2026-08-09"):
        land(spark.createDataFrame([row], DEMAND.raw), str(tmp_path), "demand", day)
    days = read_raw(spark, str(tmp_path), "demand", RAW_DEMAND_SCHEMA)
    assert sorted(str(r.dt) for r in days.collect()) == [DAY, "2026-08-09"]


BULK = [
    ("2024-01-01T23", "A", "D"), ("2024-01-02T00", "A", "D"), ("2024-01-02T23", "B", "TI"),
    ("2024-01-02T23", "A", "X"), ("2024-01-02T12", "C", "D"), ("2024-01-03T00", "B", "D"),
]


def extracted(spark, facets):
    bulk = spark.createDataFrame(BULK, "period string, respondent string, type string")
    return [tuple(r) for r in extract(bulk, facets, "2024-01-02T00", "2024-01-02T23").collect()]


def test_facets_restrict_each_other_and_offer_alternatives(spark):
    assert extracted(spark, {"respondent": ["A", "B"], "type": ["D", "TI"]}) == [BULK[1], BULK[2]]


def test_empty_facet_does_not_restrict_and_rows_come_by_period(spark):
    got = extracted(spark, {"respondent": []})
    assert got == [BULK[1], BULK[4], BULK[3], BULK[2]]


def test_extract_filters_reach_the_scan(spark, tmp_path):
    bulk = spark.createDataFrame(BULK, "period string, respondent string, type string")
    bulk.write.parquet(str(tmp_path / "bulk"))
    stored = spark.read.parquet(str(tmp_path / "bulk"))
    selected = extract(stored, {"respondent": ["A", "B"], "type": ["D"]}, "2024-01-02T00", "2024-01-02T23")
    plan = selected._jdf.queryExecution().executedPlan().toString()
    for pushed in (
        "In(respondent, [A,B])", "EqualTo(type,D)",
        "GreaterThanOrEqual(period,2024-01-02T00)", "LessThanOrEqual(period,2024-01-02T23)",
    ):
        assert pushed in plan


def test_window_prunes_the_days_of_a_bulk_table(spark, tmp_path):
    bulk = spark.createDataFrame(BULK, "period string, respondent string, type string")
    days = bulk.withColumn("dt", F.substring("period", 1, 10).cast("date"))
    days.write.partitionBy("dt").parquet(str(tmp_path / "bulk"))
    stored = spark.read.parquet(str(tmp_path / "bulk"))
    selected = extract(stored, {}, "2024-01-02T00", "2024-01-02T23")
    assert "PartitionFilters: [isnotnull(dt" in selected._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in selected.collect()] == extracted(spark, {})


def test_landing_keeps_the_feed_and_does_not_sort(spark, tmp_path, monkeypatch):
    schema = "period string, respondent string, type string, value string, `value-units` string"
    bulk = spark.createDataFrame([(*r, "1", "MWh") for r in BULK], schema)
    landed = []
    monkeypatch.setattr(daily, "land", lambda rows, *_: landed.append(rows))
    daily.land_all(dict.fromkeys(DATASETS, bulk), str(tmp_path), date(2024, 1, 2), {"type": ["X"]})
    kinds = [r for rows in landed for r in rows.collect() if r.respondent == "A"]
    assert len(kinds) == 1 and kinds[0].period == BULK[1][0]  # the demand feed's own type
    assert all("rangepartitioning" not in r._jdf.queryExecution().executedPlan().toString() for r in landed)


def test_no_scratch_folder_on_several_machines(tmp_path):
    def session(master, folder=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master)
        )

    for master in ("yarn", "spark://a:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(session(master))
        assert scratch_dir(session(master, str(tmp_path))).startswith(str(tmp_path))
    assert scratch_dir(session("local[4]")) != scratch_dir(session("local[4]"))
