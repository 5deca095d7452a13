from __future__ import annotations

import pytest
from pyspark.sql.types import DateType, IntegerType, StructType

from gridmargin.sources import versions
from gridmargin.sources.storage import write_days
from gridmargin.sources.versions import StaleVersionError, current_version, read_versions, replace_version

SCHEMA = StructType().add("x", IntegerType()).add("dt", DateType())


def put(spark, table, day, value, **more):
    frame = spark.createDataFrame([(value,)], "x int")
    return replace_version(spark, f"{table}/dt={day}", lambda path: frame.write.parquet(path), **more)


def seen(spark, table, days=None):
    return sorted((str(r.dt), r.x) for r in read_versions(spark, table, SCHEMA, days=days).collect())


def test_a_reader_between_any_two_steps_sees_the_old_or_the_new_day(spark, tmp_path, monkeypatch):
    table, day = str(tmp_path / "t"), "2026-08-08"
    put(spark, table, "2026-08-07", 5)
    for old, new in ((None, 1), (1, 2), (2, 3), (3, 4)):
        states = []

        def look():
            states.append([x for d, x in seen(spark, table) if d == day])

        created, cleaned = versions._created, versions._clean

        def creating(*args):
            look()
            out = created(*args)
            look()
            return out

        def cleaning(*args):
            look()
            cleaned(*args)
            look()

        monkeypatch.setattr(versions, "_created", creating)
        monkeypatch.setattr(versions, "_clean", cleaning)
        put(spark, table, day, new, check=look)
        monkeypatch.undo()
        before, after = [old] if old else [], [new]
        assert states == [before] * 4 + [after] * 3
        assert seen(spark, table) == [("2026-08-07", 5), (day, new)]


def test_a_frame_goes_on_reading_the_version_it_began_with(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, "2026-08-08", 1)
    begun = read_versions(spark, table, SCHEMA)
    put(spark, table, "2026-08-08", 2)
    assert [r.x for r in begun.collect()] == [1] and seen(spark, table) == [("2026-08-08", 2)]


def test_only_the_last_two_versions_stay(spark, tmp_path):
    for x in range(1, 6):
        assert put(spark, str(tmp_path), "2026-08-08", x) == x
    assert sorted(p.name for p in (tmp_path / "dt=2026-08-08").iterdir() if not p.name.startswith(".")) == [
        "_commit-4", "_commit-5", "version-4", "version-5",
    ]


def test_a_failure_leaves_the_day_as_it_was(spark, tmp_path):
    def fail():
        raise KeyError("no")

    with pytest.raises(KeyError):
        put(spark, str(tmp_path), "2026-08-08", 1, check=fail)
    assert not any(p for p in tmp_path.rglob("*") if not p.name.startswith("."))
    put(spark, str(tmp_path), "2026-08-08", 1)
    with pytest.raises(KeyError):
        put(spark, str(tmp_path), "2026-08-08", 2, check=fail)
    assert seen(spark, str(tmp_path)) == [("2026-08-08", 1)]


def test_a_writer_that_was_overtaken_is_refused(spark, tmp_path):
    folder = f"{tmp_path}/dt=2026-08-08"
    put(spark, str(tmp_path), "2026-08-08", 1)
    with pytest.raises(StaleVersionError):
        put(spark, str(tmp_path), "2026-08-08", 2, check=lambda: put(spark, str(tmp_path), "2026-08-08", 3))
    assert seen(spark, str(tmp_path)) == [("2026-08-08", 3)]
    read = current_version(spark, folder)
    put(spark, str(tmp_path), "2026-08-08", 4)
    with pytest.raises(StaleVersionError):
        put(spark, str(tmp_path), "2026-08-08", 5, based_on=read)
    assert seen(spark, str(tmp_path)) == [("2026-08-08", 4)]


def test_plain_days_are_version_zero(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "2026-08-07"), (2, "2026-08-08")], "x int, day string")
    write_days(rows.selectExpr("x", "cast(day as date) as dt"), table, "dt", "x")
    assert seen(spark, table) == [("2026-08-07", 1), ("2026-08-08", 2)]
    put(spark, table, "2026-08-08", 3)
    assert seen(spark, table) == [("2026-08-07", 1), ("2026-08-08", 3)]
    assert seen(spark, table, ["2026-08-07", "2026-01-01"]) == [("2026-08-07", 1)]
    put(spark, table, "2026-08-08", 4)
    put(spark, table, "2026-08-08", 5)
    assert not list((tmp_path / "t" / "dt=2026-08-08").glob("*.parquet"))
    assert seen(spark, table) == [("2026-08-07", 1), ("2026-08-08", 5)]
    assert seen(spark, str(tmp_path / "none")) == seen(spark, table, ["2026-01-01"]) == []


def test_a_day_filter_prunes_folders(spark, tmp_path):
    for day in ("2026-08-07", "2026-08-08"):
        put(spark, str(tmp_path), day, 1)
    frame = read_versions(spark, str(tmp_path), SCHEMA).filter("dt = date'2026-08-08'")
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and [r.x for r in frame.collect()] == [1]
