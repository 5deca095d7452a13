"""Small tables with every odd case, and brute-force helpers."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi omikron pi".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, n string, fp string, score string, kept string, starts string, weight string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(400)}" for _ in range(n))


def odd_documents() -> list[tuple]:
    """Ids, texts, languages and sources: nulls, empties, copies, near copies, a long text."""
    rng = random.Random(5)
    base, shared = sentence(rng, 120), sentence(rng, 60)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    texts = [
        base, base, near, None, "", "  \n\t ", "one", "Two words", shared + " " + sentence(rng, 30),
        sentence(rng, 25) + "\n" + shared, sentence(rng, 3000), "ha " * 300, "é ü ß " * 90, base.upper(),
        sentence(rng, 40) + " *** ### $$$", sentence(rng, 80), sentence(rng, 81), sentence(rng, 300),
    ]
    rows = [
        (i, t, None if i == 4 else ("en", "de")[i % 2], None if i == 5 else "s" * (i % 3 > 0), len(t or ""))
        for i, t in enumerate(texts)
    ]
    rows += [rows[8], rows[8], (None, sentence(rng, 50), None, None, None), (None, None, None, None, None)]
    return rows


def documents(spark, rows=None):
    """The documents with columns whose names the operators use themselves."""
    rows = odd_documents() if rows is None else rows
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "s", "k", "st", "w") for r in rows], SCHEMA)


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
