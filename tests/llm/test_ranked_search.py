from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridmargin.llm import ranked_search as module
from gridmargin.llm.ranked_search import Shard, ranked_search, search_shard
from tests.llm.samples import documents, odd_documents, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score long, query string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(docs, items, most):
    held = [(i, Counter(terms(t))) for i, t, *_ in docs]
    held = [(i, c) for i, c in held if c]
    documents_, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in held:
            m = 10 + 90 * c.total() * documents_ // total
            score = sum(
                math.floor(1000 * math.log((2 * documents_ + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=str)


def items_of(rows):
    rng = random.Random(9)
    texts = [sentence(rng, 20), rows[0][1][:200], "", None, "é ha ONE", "nowhere", rows[8][1], "a-b_c two\x7fwords"]
    items = [(i, t) for i, t in enumerate(texts)]
    return [*items, items[1], (4, "two words"), (None, "ha")]


@pytest.mark.parametrize("shard, block", [(2_000_000, 4_000_000), (300, 500), (1, 4_000_000)])
def test_search_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(module, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(module, "QUERY_BYTES", block)
    rows = odd_documents()
    items = items_of(rows)
    frame = spark.createDataFrame([(*x, 1, 2, "q") for x in items], ITEMS)
    got = ranked_search(documents(spark, rows), frame, 5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == slow_search(rows, items, 5)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "ha", 1, 2, "q")], ITEMS)
    assert ranked_search(documents(spark, []), items).count() == 0
    assert ranked_search(documents(spark), items.limit(0)).count() == 0


def test_shard_search_finds_the_best_with_ties():
    rng = np.random.default_rng(4)
    for documents_ in (1, 7, 400):
        dense = rng.integers(1, 50, (6, documents_)) * (rng.random((6, documents_)) < 0.4)
        lists, places = np.nonzero(dense)
        shard = Shard.of(documents_, lists, places, dense[lists, places])
        weights = np.array([3, 1, 0, 2, 5, 1])
        scores = weights @ dense
        got = sorted(search_shard(shard, np.arange(6), weights, 10))
        least = max(1, np.sort(scores)[::-1][:10][-1])
        assert got == sorted((int(s), i) for i, s in enumerate(scores) if s >= least)


def test_range_maxima():
    rng = np.random.default_rng(5)
    dense = rng.integers(0, 9, (3, 200))
    lists, places = np.nonzero(dense)
    shard = Shard.of(200, lists, places, dense[lists, places])
    low = rng.integers(0, 200, 300)
    high = low + rng.integers(0, 60, 300)
    found = shard.largest(np.arange(3), low, np.minimum(high, 200))
    values = np.where(found >= 0, shard.impacts[found], 0)
    for a, b, row in zip(low, high, values, strict=True):
        assert row.tolist() == [max([0, *dense[t, a:b]]) for t in range(3)]
