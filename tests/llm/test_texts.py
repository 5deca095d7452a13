from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridmargin.llm import gru, mixing, quality, rules
from gridmargin.llm.lm_scoring import score_documents
from gridmargin.llm.packing import binary_lengths, default_tokenizer, encoder, pack_power_of_two
from gridmargin.llm.simhash import words_of
from tests.llm.samples import WORDS, documents, odd_documents, sentence

LABELS = "doc_id long, quality int, toxic int, score string"


def labelled(n=240):
    """Documents of which every third is shouting or repeats itself, and their labels."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, rng.randrange(60, 140)).replace(" ", ". ", 3)
        if i % 3 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else "ha ha ha " * 40
        rows.append((1000 + i, text, "en", "s", len(text)))
        labels.append((1000 + i, int(i % 3 > 0), 0, ""))
    return rows, labels


def test_quality_ranks_and_cuts(spark):
    rows, labels = labelled()
    docs = documents(spark, rows + odd_documents())
    table = spark.createDataFrame([*labels, (None, 1, 0, ""), (1001, None, 0, ""), (77777, 1, 0, "")], LABELS)
    ranking = quality.train_ranking(docs, table)
    scored = quality.score_quality(docs, ranking)
    assert scored.columns == docs.columns
    found = {r.doc_id: r.score for r in scored.collect()}
    held = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held
    assert all((found[i] >= quality.CUTOFF) == bool(i % 3 != 1000 % 3) for i in held)
    assert all(0 <= s <= 1 for s in found.values())


def test_quality_without_labels(spark):
    docs = documents(spark)
    for labels in ([], [(1, 1, 0, "")]):
        ranking = quality.train_ranking(docs, spark.createDataFrame(labels, LABELS))
        scores = {r.score for r in quality.score_quality(docs, ranking).collect()}
        assert len(scores) == 1 and scores.pop() > quality.CUTOFF
    assert quality.score_quality(documents(spark, []), ranking).count() == 0


def slow_counts(text):
    words = [w.decode() for w in (text or "").encode().split()]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_counts(spark):
    extra = ["a b c a b c a b", "a a a", "x\n\nx\n x\nx", "a|b #\n\ta|b #\na|b #", "é é a\x0bb"]
    rows = odd_documents() + [(500 + i, t, "en", "s", 0) for i, t in enumerate(extra)]
    for r in rules.text_counts(documents(spark, rows).withColumn("text2", F.col("text"))).collect():
        assert tuple(r[c] for c in rules.BASE) == slow_counts(r.text2)
    assert rules.judge(documents(spark, []), spark.createDataFrame([], LABELS), F.col("lang")).count() == 0


def binomial(k, n, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 10, 400, 3000) for k in (0, 1, 2, 5, 9) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.withColumn("p", rules.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect():
        assert r.p == pytest.approx(binomial(r.k, r.n, 0.01) if r.k < r.n * 0.01 else 1.0, rel=1e-9)


def test_certified_cutoffs_hold_the_risk(spark):
    rng = random.Random(3)
    rows = [
        (stratum, 0, 100, 100, rng.choice([0] * 180 + [3, 30, 150]), 10, 0, 100, 0)
        for stratum, n in (("large", 4000), ("small", 60))
        for _ in range(n)
    ]
    names = "stratum string, n_upper int, word_chars int, n_chars int, n_symbols int, n_lines int, n_dup_lines int, n_words int, n_repeat_words int"
    good = spark.createDataFrame(rows, names)
    found = {r.stratum: r for r in rules.certified_cutoffs(good).collect()}
    assert "small" not in found  # too few to certify anything
    for rule, (_, _, cutoffs) in rules.RULES.items():
        above = {c: sum(1000 * r[4] > r[2] * c for r in rows if r[0] == "large") if rule == "symbols" else 0 for c in cutoffs}
        level = rules.ERROR / (2 * len(rules.RULES))
        best = None
        for c in cutoffs:
            if binomial(above[c], 4000, rules.RISK / len(rules.RULES)) > level:
                break
            best = c
        assert found["large"][f"cut_{rule}"] == best


def test_verdict(spark):
    rows, labels = labelled(2400)
    judged = rules.judge(documents(spark, rows), spark.createDataFrame(labels, LABELS), F.col("lang"))
    found = {r.doc_id: r for r in judged.collect()}
    assert all(found[i].kept for i, q, *_ in labels if q)
    assert not any(found[i].kept for i, q, *_ in labels if not q)


def test_verdict_keeps_columns_of_any_name(spark):
    rows, labels = labelled(300)
    plain = documents(spark, rows)
    names = ["_words", "_lines", "_hash", "_order", "_text", "row", "stratum", "cut_lines", "a.b", "n_upper"]
    docs = plain.drop(*names).select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    table = spark.createDataFrame(labels, LABELS)
    expected = {r.doc_id: r for r in rules.judge(plain, table, F.col("lang")).collect()}
    got = rules.judge(docs, table, F.col("lang")).collect()
    assert len(got) == len(expected)
    for r in got:
        assert all(r[n] == f"{n}{r.doc_id}" for n in names[:-1])
        same = [*rules.COUNTS, "base_failed", "kept", "lang"]
        assert [r[c] for c in same] == [expected[r.doc_id][c] for c in same]


def test_repeated_labelled_rows_count_once(spark, monkeypatch):
    rows, labels = labelled()
    once = quality.train_ranking(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    fitted = []
    monkeypatch.setattr(quality, "fit_ranking", lambda x, y: fitted.append(len(x)) or once)
    quality.train_ranking(documents(spark, rows * 3), spark.createDataFrame(labels * 2, LABELS))
    quality.train_ranking(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert fitted[0] == fitted[1] <= len(labels)


def test_binary_lengths():
    for n in range(1, 300):
        pieces = binary_lengths(n, 64)
        assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 64 for p in pieces)
        assert len([p for p in pieces if p < 64]) == len({p for p in pieces if p < 64})


def test_packing_round_trip(spark):
    odd = ["<|endoftext|> x<|startoftext|>", "don't it's WE'LL", "a b c", "日本語 text ١٢٣ ½ İ", "x\x1cy é ﬁ", "ab12cd!?#", "\U0001f600 ok"]
    rows = odd_documents() + [(700 + i, t, "en", "s", 0) for i, t in enumerate(odd)]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces = pack_power_of_two(documents(spark, rows), default_tokenizer()).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    by_id: dict = {}
    for p in pieces:
        assert p.length == 1 << p.bucket and p.offset == 0 and len(p.ids) == 4 * p.length
        by_id.setdefault(p.doc_id, []).append(p)
    for i, text, *_ in rows:
        if i is None or i == 8:  # several rows of one id
            continue
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted(by_id[i], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == ids.tobytes()
        assert [p.start for p in mine] == np.cumsum([0, *[p.length for p in mine]])[:-1].tolist()
        assert {p.doc_tokens for p in mine} == {len(ids)}
    assert len(by_id[8]) % 3 == 0
    assert pack_power_of_two(documents(spark, []), default_tokenizer()).count() == 0
    with pytest.raises(ValueError):
        pack_power_of_two(documents(spark, []), default_tokenizer(), 1000)


def test_word_cache_is_bounded(monkeypatch):
    from gridmargin.llm import packing

    monkeypatch.setattr(packing, "_CACHED", 10)
    words = packing.WordEncoder(default_tokenizer())
    texts = [sentence(random.Random(i), 30) for i in range(5)]
    whole = encoder(default_tokenizer())
    assert [words.encode(t) for t in texts] == [whole.encode(t) for t in texts]
    assert len(words.words) < 60


def test_raking(spark):
    rng = random.Random(8)
    cells = [(s, lang, t, rng.randrange(50, 5000)) for s in "abcd" for lang in ("en", "de") for t in range(3)]
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    targets = {
        "source": dict(zip("abcd", (0.4, 0.3, 0.2, 0.1), strict=True)),
        "lang": {"en": 0.5, "de": 0.5},
        "topic": {0: 0.2, 1: 0.3, 2: 0.5},
    }
    frames = {n: spark.createDataFrame(list(v.items()), f"value {'int' if n == 'topic' else 'string'}, share double") for n, v in targets.items()}
    got = {tuple(r)[:3]: r.weight for r in mixing.rake(df, frames).collect()}
    weight = {c[:3]: 1.0 for c in cells}
    total = sum(c[3] for c in cells)
    for _ in range(mixing.ROUNDS):
        for d, name in enumerate(mixing.DIMENSIONS):
            for value, share in targets[name].items():
                now = sum(weight[c[:3]] * c[3] for c in cells if c[d] == value)
                for c in cells:
                    if c[d] == value:
                        weight[c[:3]] *= share * total / now
    assert got == pytest.approx(weight, rel=1e-9)
    weighted = mixing.rake(df, frames)
    scale = mixing.kept_scale(weighted, 0.6)
    kept = sum(c[3] * min(1, weight[c[:3]] * scale) for c in cells)
    assert kept / total == pytest.approx(0.6, abs=1e-3)


def test_mixing_documents(spark):
    docs = documents(spark)
    mixed = mixing.mix_documents(docs).collect()
    assert len(mixed) == len(odd_documents())
    assert all(0 < r.probability <= 1 and r.facts.tokens == len(words_of(r.text)) for r in mixed)
    assert len({(r.facts.topic, r.kept) for r in mixed if r.doc_id == 8}) == 1
    sure = mixing.mix_documents(docs, share=1.0).collect()
    assert all(r.kept for r in sure)
    assert mixing.mix_documents(documents(spark, [])).count() == 0


def test_gradients():
    rng = np.random.default_rng(1)
    p = gru.initial(np.arange(1024, 0, -1.0), np.ones(gru.TAIL_CLASSES) * 50)
    p = gru.Parameters(p.flat.astype(np.float64))
    docs = [np.append(rng.integers(0, gru.INPUTS, n), 0) for n in (9, 7, 4)]
    got, *_, n = gru._window_gradient(p, docs, np.zeros((3, gru.HIDDEN)), np.zeros(3, np.int64))
    for i in rng.choice(np.flatnonzero(np.abs(got) > 1e-3), 25):
        value, step = p.flat[i], 1e-4
        p.flat[i] = value + step
        up = gru.log_likelihoods(p, docs).sum()
        p.flat[i] = value - step
        down = gru.log_likelihoods(p, docs).sum()
        p.flat[i] = value
        assert got[i] == pytest.approx(-(up - down) / (2 * step * n), rel=0.02, abs=2e-4)


def test_state_is_carried_and_lanes_do_not_mix():
    rng = np.random.default_rng(2)
    p = gru.initial(np.arange(1024, 0, -1.0), np.ones(gru.TAIL_CLASSES))
    docs = [np.append(rng.integers(0, gru.INPUTS, n), 0) for n in (200, 3, 64, 1, 95)]
    together = gru.log_likelihoods(p, docs)
    assert together == pytest.approx([gru.log_likelihoods(p, [d])[0] for d in docs], rel=1e-5)
    # All classes and head words sum to one after any text.
    states = rng.standard_normal((4, gru.HIDDEN)).astype(np.float32)
    head = np.tile(np.arange(gru.HEAD), (4, 1))
    sums = [np.exp(gru._token_logs(p, np.repeat(states[i : i + 1], gru.HEAD, 0), head[i])).sum() for i in range(4)]
    tails = np.arange(gru.HEAD, gru.INPUTS)
    sums = [s + np.exp(gru._token_logs(p, np.repeat(states[i : i + 1], len(tails), 0), tails)).sum() for i, s in enumerate(sums)]
    assert sums == pytest.approx([1.0] * 4, rel=1e-4)


def test_scores(spark):
    rng = random.Random(6)
    rows = odd_documents()
    for i in range(60):  # two languages, told apart by what came before
        ending = "ou" if i % 2 else "en"
        rows.append((100 + i, " ".join(rng.choice(WORDS) + ending for _ in range(90)), "en", "s", 0))
    got = score_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, *_ in rows}
    count: Counter = Counter()
    for i, t, *_ in rows:
        if not held[i]:
            count.update([*words_of(t), b""])
    n, v = sum(count.values()), len(count)
    expected: Counter = Counter()
    for i, t, *_ in rows:
        words = [*words_of(t), b""]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        expected[i, held[i], len(words), sum(count[w] > 0 for w in words), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    late = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 100]
    assert late and sum(r.score for r in late) > sum(r.base_score for r in late)


def test_scores_without_training_documents(spark):
    only = [r for r in odd_documents() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1]
    got = score_documents(documents(spark, only)).collect()
    assert len(got) == len(only)
    assert {(r.train_tokens, r.n_known, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert score_documents(documents(spark, [])).count() == 0
