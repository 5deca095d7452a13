from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from gridmargin.llm import minimisers, superkmers
from gridmargin.llm.common import connected_components
from gridmargin.llm.simhash import (
    linked_fingerprints,
    shingles_of,
    simhash,
    simhash_groups,
    without_near_copies,
)
from gridmargin.llm.suffixes import (
    remove_repeated_bytes,
    repeat_groups,
    repeated_bytes,
    repeated_starts,
)
from gridmargin.llm.superkmers import later_windows, remove_repeated_words
from tests.llm.samples import components, documents, odd_documents, sentence


def slow_simhash(text, width):
    words = (text or "").encode().translate(bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))).split()
    grams = [words[i : i + width] for i in range(len(words) - width + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", [r[1] for r in odd_documents()])
def test_simhash(text):
    assert simhash(text, 3) & (1 << 64) - 1 == slow_simhash(text, 3)


def test_links_of_two_bits(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(63) for _ in range(30)]
    values = {c ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4))) for c in centres for _ in range(8)}
    links = linked_fingerprints(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    near = [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert all((r.a ^ r.b).bit_count() <= 2 for r in links)
    assert components(values, [(r.a, r.b) for r in links]) == components(values, near)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e}
    assert {n: got.get(n, n) for n in nodes} == components(nodes, edges)


def test_simhash_groups(spark):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash_groups(documents(spark)).collect()}
    assert simhash_groups(documents(spark)).count() == len(odd_documents())
    rows = [(i, simhash(t, 3)) for i, t, *_ in odd_documents()]
    prints = {f for _, f in rows}
    near = [(a, b) for a, b in combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    group = components(prints, near)
    least = {}
    for i, f in rows:
        least.setdefault(group[f], []).append(i)
    for i, f in rows:
        known = [x for x in least[group[f]] if x is not None]
        assert got[i, f] == (min(known) if known else None)


def slow_words(rows, k):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for a in range(len(words) - k + 1):
            window = tuple(words[a : a + k])
            if window in seen:
                gone[a : a + k] = [True] * k
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[i, len(words), sum(gone), hashlib.sha256(kept).digest()] = True
    return set(out)


@pytest.mark.parametrize("bucket", [1 << 19, 0])
def test_repeated_words(spark, bucket, monkeypatch):
    later = superkmers.later_windows
    monkeypatch.setattr(superkmers, "later_windows", lambda docs, k: later(docs, k, bucket))
    got = remove_repeated_words(documents(spark), 20).collect()
    assert len(got) == len(odd_documents())
    rows = [(i, t) for i, t, *_ in odd_documents()]
    found = {(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).digest()) for r in got}
    assert found == slow_words(rows, 20)


def slow_bytes(rows, k):
    rows = {(i, (t or "").encode()) for i, t in rows}
    count = Counter(d[a : a + k] for _, d in rows for a in range(len(d) - k + 1))
    out = set()
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for a in range(len(data) - k + 1):
            if count[data[a : a + k]] > 1:
                gone[a : a + k] = True
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.add((i, len(data), int(gone.sum()), spans, kept))
    return out


@pytest.mark.parametrize("bucket", [1 << 22, 0])
def test_repeated_bytes(spark, bucket, monkeypatch):
    from gridmargin.llm import suffixes

    every = suffixes.repeated_bytes
    monkeypatch.setattr(suffixes, "repeated_bytes", lambda docs, k: every(docs, k, bucket))
    got = remove_repeated_bytes(documents(spark), 200).collect()
    assert len(got) == len(odd_documents())
    found = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got}
    assert found == slow_bytes([(i, t) for i, t, *_ in odd_documents()], 200)


def test_maximal_repeats():
    rng = random.Random(3)
    for trial in range(150):
        k = rng.choice([2, 3, 5])
        letters = b"ab" if trial % 2 else b"abc"
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 22))) for _ in range(rng.randint(1, 5))]
        count = Counter(s[i : i + k] for s in strings for i in range(len(s) - k + 1))
        marked = [m.tolist() for m in repeated_starts(strings, k)]
        assert marked == [[count[s[i : i + k]] > 1 for i in range(len(s) - k + 1)] for s in strings]
        places: dict = {}
        for a, s in enumerate(strings):
            for i in range(len(s)):
                for j in range(i + k, len(s) + 1):
                    places.setdefault(s[i:j], []).append((a, i))
        expected = set()
        for w, at in places.items():
            before = {strings[a][i - 1] if i else (a, i) for a, i in at}
            after = {strings[a][i + len(w)] if i + len(w) < len(strings[a]) else (a, i) for a, i in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                expected.add((len(w), tuple(at)))
        assert {(n, tuple(sorted(at))) for n, at in repeat_groups(strings, k)} == expected


def test_runs_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(4)
    docs = [sentence(rng, 700).encode(), b"", b"short", b"a" * 900, sentence(rng, 90).encode()]
    for windows in (minimisers.Windows(20, 4, True), minimisers.Windows(200, 32, False)):

        def all_windows():
            out = {}
            for number, mini, _, start, count in minimisers.document_runs(docs, windows):
                for d, m, s, n in zip(number, mini, start, count):
                    out.update({(int(d), int(s) + j): int(m) for j in range(int(n))})
            return out

        whole = all_windows()
        monkeypatch.setattr(minimisers, "_CHUNK", 300)
        assert all_windows() == whole
        monkeypatch.undo()
        assert len(whole) == sum(max(0, windows.units(d) - windows.k + 1) for d in docs)


def test_one_of_each_group_stays(spark):
    """All columns stay; the rows that stay are those that name their group."""
    docs = documents(spark)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = kept.collect()
    named = {r.component_id for r in simhash_groups(docs).collect()}
    assert sorted((r.doc_id for r in rows), key=str) == sorted(named, key=str)
    texts = {(i, t) for i, t, *_ in odd_documents()}
    assert {(r.doc_id, r.text) for r in rows} <= texts and rows[0].n == "y"
    ids = [r.doc_id for r in rows]
    assert 0 in ids and not {1, 13} & set(ids) and ids.count(8) == 1 and ids.count(3) == 1
    lost = documents(spark, [(None, "a b c d", None, None, 1), (None, "a b c d", None, None, 1), (7, "a b c d", None, None, 1)])
    assert [r.doc_id for r in without_near_copies(lost).collect()] == [7]


def test_no_documents(spark):
    none = documents(spark, [])
    assert simhash_groups(none).count() == 0
    assert remove_repeated_words(none).count() == 0
    assert remove_repeated_bytes(none).count() == 0
    assert without_near_copies(none).count() == 0
    keyed = minimisers.keyed(none)
    assert later_windows(keyed, 20).count() == repeated_bytes(keyed, 200).count() == 0
