from __future__ import annotations

from gridmargin.llm.superkmers import with_windows


def test_windows_of_repeated_rows_count_once(spark):
    docs = spark.createDataFrame([(7,)] * 5 + [(8,)], "row long")
    windows = spark.createDataFrame([(7, 3, 2), (7, 9, 1)] * 5, "row long, start long, n long")
    got = with_windows(docs, windows).collect()
    assert len(got) == 6
    for r in got:
        if r.row == 7:
            assert sorted(zip(r.starts, r.counts, strict=True)) == [(3, 2), (9, 1)]
        else:
            assert r.starts is None and r.counts is None
