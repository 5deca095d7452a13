from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract
from gridmargin.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("query", sorted(ORACLE))
def test_query_matches_sql(spark, query):
    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    frame = QUERIES[query](spark, SF_DIR)
    rows = connection.execute(f"select {', '.join(frame.columns)} from ({ORACLE[query]})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(rows)
