from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from gridmargin.llm import gru, lm_scoring


def _profiles(spark, n, blocks):
    rng = np.random.default_rng(1)
    rows = [(i % blocks, rng.integers(0, 100, 5).astype("<i2").tobytes()) for i in range(n)]
    return spark.createDataFrame(rows, "block int, inputs binary")


def test_network_reads_every_training_document(spark):
    profiles = _profiles(spark, 3000, 4)
    start = gru.initial(np.ones(101), np.ones(gru.TAIL_CLASSES))
    aside = profiles.filter(lm_scoring.checked()).count()
    assert 100 < aside < 300
    parts = lm_scoring.train_blocks(profiles, start, 4).collect()
    assert sum(r.tokens for r in parts) == 5 * (3000 - aside)
    trained = lm_scoring.train_network(profiles, start, 4)
    assert np.isfinite(trained.flat).all()


def test_average_is_by_tokens_whatever_the_tree(spark):
    weights = np.random.default_rng(2).standard_normal((40, gru.SIZE))
    rows = [(i, i + 1, weights[i].tobytes()) for i in range(40)]
    parts = spark.createDataFrame(rows, "part int, tokens long, weights binary")
    tokens, mean = lm_scoring.average(parts, 40)
    assert tokens == 820
    np.testing.assert_allclose(mean, np.average(weights, axis=0, weights=np.arange(1, 41)), atol=1e-12)
    assert lm_scoring.average(parts.filter("part < 0"), 40) == (0, None)


def test_training_does_not_depend_on_the_order():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, gru.INPUTS, rng.integers(1, 90)) for _ in range(300)]
    start = gru.initial(np.ones(gru.HEAD), np.ones(gru.TAIL_CLASSES))
    one, tokens = gru.train(start, docs)
    other, _ = gru.train(start, [docs[i] for i in rng.permutation(300)])
    assert tokens == sum(map(len, docs))
    assert (one.flat == other.flat).all() and (one.flat != start.flat).any()


@pytest.fixture(scope="module")
def corpus():
    """Texts whose words tell which come next, with odd ones."""
    rng = random.Random(5)
    rows = [(0, ""), (1, None), (None, "alone"), (2, "b b b"), (2, "b b b")]
    for i in range(10, 700):
        kind = rng.randrange(4)
        rows.append((i, " ".join(f"w{kind}x{rng.randrange(60)}" for _ in range(rng.randrange(5, 80)))))
    return rows


def test_scores_do_not_depend_on_the_layout(spark, corpus, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 40_000)  # several blocks
    found = []
    for parts, batch in ((1, "10000"), (8, "7")):
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            rows = corpus if parts == 1 else corpus[::-1]
            docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
            got = lm_scoring.score_documents(docs).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        found.append(sorted((-1 if r.doc_id is None else r.doc_id, r.base_score, r.score) for r in got))
    assert len(found[0]) == len(corpus)
    np.testing.assert_allclose(found[0], found[1], rtol=1e-6)


def test_network_beats_its_base_on_held_out_documents(spark, corpus):
    got = lm_scoring.score_documents(spark.createDataFrame(corpus, "doc_id long, text string")).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held if r.doc_id} == {
        i for i, _ in corpus if i and zlib.crc32(str(i).encode()) % 5 == 1
    }
    tokens = sum(r.n_tokens for r in held)
    better = (sum(r.score for r in held) - sum(r.base_score for r in held)) / tokens
    assert better * math.log(10) > 0.2
