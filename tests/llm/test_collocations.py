from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from gridmargin.llm.collocations import (
    collocations,
    distinct_rows,
    frequent_prefixes,
    packed,
    phrase_counts,
    suffixes,
    tokens_of,
    unpacked,
)
from tests.llm.samples import WORDS, documents, odd_documents


def slow_counts(rows, depth):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "")):
            words = re.findall(r"[^\x20\x09]+", re.sub("[A-Z]", lambda m: m[0].lower(), piece))
            totals[lang] += len(words)
            for k in range(1, depth + 1):
                counts.update((lang, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, +totals


def slow_collocations(counts, totals, least, most):
    parts = {(lang, tuple(p.split(" "))): f for (lang, p), f in counts.items()}
    out = []
    for (lang, w), a in parts.items():
        if len(w) < 2 or a < least:
            continue
        covers = [
            f for (other, v), f in parts.items()
            if other == lang and len(v) > len(w) and f >= least and any(v[i : i + len(w)] == w for i in range(len(v)))
        ]
        if covers and 100 * max(covers) >= 80 * a:
            continue
        score, _, l, r = min((2_000_000 * a // (parts[lang, w[:k]] + parts[lang, w[k:]]), k, parts[lang, w[:k]], parts[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= most:
            ranked.append((lang, rank[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return ranked


def sentences(seed, n, langs=("en", "de", None)):
    """Few words, so that phrases recur, with hot ones and every kind of separator."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS[:3]) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(rng.randrange(60))]
        text = "".join(w.upper() * (rng.random() < 0.1) or w for w in [x + rng.choice([" "] * 8 + ["\t", ". ", "\n", "!", "; "]) for x in words])
        rows.append((i, text, langs[i % len(langs)], "s", len(text)))
    return rows


@pytest.mark.parametrize("bucket_words, hot_words", [(4_000_000, 4096), (200, 6), (40, 100)])
def test_phrases_against_brute_force(spark, bucket_words, hot_words):
    rows = sentences(2, 150) + odd_documents()
    counts, totals = slow_counts(rows, 4)
    phrases, words = phrase_counts(documents(spark, rows), 4, 5, bucket_words, hot_words)
    got = [tuple(r) for r in phrases.collect()]
    assert len(got) == len(set(got))
    assert {(lang, p): f for lang, p, f in got} == {k: f for k, f in counts.items() if f >= 5}
    assert {r.lang: r.n for r in words.collect()} == dict(totals)
    best = [tuple(r) for r in collocations(phrases, words, most=40).orderBy("lang", "rank").collect()]
    assert best == slow_collocations(counts, totals, 5, 40)


def test_large_products(spark):
    """Counts whose products pass 64 bits."""
    a, l = 6 * 10**12, 7 * 10**12
    phrases = spark.createDataFrame([("en", "x y", a), ("en", "x", l), ("en", "y", a)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    row = collocations(phrases, totals).first()
    assert row.score == 2_000_000 * a // (l + a) and row.n == 10**14


def test_no_documents(spark):
    for rows in ([], [(1, None, "en", "s", 0), (2, " .\n! ", None, "s", 4)]):
        phrases, totals = phrase_counts(documents(spark, rows))
        assert collocations(phrases, totals).count() == phrases.count() == totals.count() == 0


def test_tokens_end_pieces():
    assert tokens_of("A b.C\td\x1fe\n f") == [b"a", b"b", b".", b"c", b"d\x1fe", b".", b"f"]


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(1)
    rows = suffixes(rng.integers(0, 5, 4000), 4)
    rows, counts = distinct_rows(rows, 5)
    slow: Counter = Counter()
    for r, n in zip(rows.tolist(), counts.tolist(), strict=True):
        for k in range(2, 5):
            if r[k - 1]:
                slow[tuple(r[:k])] += n
    got = {}
    for k, pointers, sizes in frequent_prefixes(np.ascontiguousarray(rows.T), counts, 20):
        got |= {tuple(rows[p, :k].tolist()): n for p, n in zip(pointers.tolist(), sizes.tolist(), strict=True)}
    assert got == {k: n for k, n in slow.items() if n >= 20}


def test_rows_of_many_words_are_distinct():
    rows = np.random.default_rng(3).integers(1, 1 << 28, (500, 4))
    rows = np.concatenate([rows, rows[:100]])
    found, counts = distinct_rows(rows, 1 << 28)
    assert {tuple(r): n for r, n in zip(found.tolist(), counts.tolist(), strict=True)} == Counter(map(tuple, rows.tolist()))


def test_packing_suffixes_round_trip():
    words = [b".", b"a", b"bb", "ü".encode(), b"d"]
    rows = np.array([[1, 4, 0, 0], [1, 1, 3, 4], [3, 1, 1, 1]])
    own, columns, counts = unpacked(*packed(words, rows, np.array([7, 70_000, 1])), 4)
    back = [[own[i - 1] if i else None for i in r] for r in columns.T.tolist()]
    assert back == [[words[i] if i else None for i in r] for r in rows.tolist()] and counts.tolist() == [7, 70_000, 1]
