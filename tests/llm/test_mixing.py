from __future__ import annotations

import random

import numpy as np
import pytest

from gridmargin.llm import mixing
from gridmargin.llm.simhash import words_of
from tests.llm.samples import documents, sentence


def test_topics_come_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "START_SAMPLE", 10, raising=False)
    monkeypatch.setattr(mixing, "TOPIC_SAMPLE", 10, raising=False)
    rng = random.Random(1)
    rows = [(i, sentence(rng, 30), "fi" if i % 40 == 0 else "en", "s", 0) for i in range(200)]
    means, centres = mixing.topic_centres(documents(spark, rows))
    profiles = {lang: [mixing.word_profile(words_of(t)) for _, t, x, *_ in rows if x == lang] for lang in ("en", "fi")}
    for lang, some in profiles.items():
        assert means[lang] == pytest.approx(np.mean(some, axis=0), abs=1e-6)
    assert np.linalg.norm(centres, axis=1) == pytest.approx([1.0] * mixing.TOPICS, rel=1e-5)


def test_achieved_shares_on_skewed_cells(spark):
    """Cells are clipped, but every value that has enough tokens meets its target."""
    cells = [("a", "x", 0, 60_000), ("a", "y", 0, 900), ("b", "x", 1, 30_000), ("b", "y", 1, 8_000),
             ("a", "x", 1, 700), ("b", "x", 0, 400), ("c", "y", 0, 50), ("c", "x", 1, 50)]
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    targets = mixing.tempered_targets(df)
    total = sum(c[3] for c in cells)
    kept = 0.5 * total
    chances = mixing.bounded(mixing.rake(df, targets), targets, 0.5)
    got = chances.collect()
    report = {(r.dimension, r.value): r for r in mixing.achieved_shares(chances, targets).collect()}
    assert max(r.probability for r in got) == 1 and all(0 < r.probability <= 1 for r in got)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(kept, rel=0.02)
    for name in mixing.DIMENSIONS:
        for value, share in targets[name].collect():
            has = sum(r.tokens for r in got if r[name] == value)
            achieved = sum(r.tokens * r.probability for r in got if r[name] == value)
            wanted = share * kept
            row = report[name, str(value)]
            assert (row.tokens, row.target) == (has, share)
            assert row.achieved == pytest.approx(achieved / sum(r.tokens * r.probability for r in got))
            if wanted <= has:
                assert achieved == pytest.approx(wanted, rel=0.05)
            else:
                assert achieved == pytest.approx(has, rel=0.02)


def test_raking_stops_when_all_targets_are_met(spark, monkeypatch):
    """Cells that are independent fit after one round; no further ones change them."""
    cells = [(s, x, t, 100 * (i + 1) * (j + 1) * (t + 1)) for i, s in enumerate("ab") for j, x in enumerate("xyz") for t in range(2)]
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    targets, cuts = mixing.tempered_targets(df), []
    plain = mixing.checkpointed
    monkeypatch.setattr(mixing, "checkpointed", lambda frame: cuts.append(1) or plain(frame))
    weighted = mixing.rake(df, targets)
    assert len(cuts) == 1
    total = sum(c[3] for c in cells)
    goals = {name: {r.value: r.share * total for r in targets[name].collect()} for name in mixing.DIMENSIONS}
    for name, wanted in goals.items():
        sums = weighted.groupBy(name).agg({"*": "count"}).count()
        assert sums == len(wanted)
        for value, goal in wanted.items():
            got = sum(r.weight * r.tokens for r in weighted.collect() if r[name] == value)
            assert got == pytest.approx(goal, rel=1e-9)


def test_topics_do_not_depend_on_the_layout(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, 5 + i % 60), ("fi", "en", None)[i % 3], "s", 0) for i in range(600)]
    whole = documents(spark, rows)
    conf, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    try:
        for parts, batch in ((1, 10_000), (7, 10_000), (3, 11)):
            spark.conf.set(conf, str(batch))
            means, centres = mixing.topic_centres(whole.orderBy("text").repartition(parts))
            found.append(({k: v.tolist() for k, v in means.items()}, centres.tolist()))
    finally:
        spark.conf.set(conf, before)
    assert found[0] == found[1] == found[2]
