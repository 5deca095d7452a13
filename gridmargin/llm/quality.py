"""Quality classifier: Bradley-Terry ranking from preference pairs, cut at a score quantile."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridmargin.llm.common import table

CUTOFF = 0.3
# Most labelled rows that the classifier is fitted on, those with the smallest hash of doc_id.
SAMPLE_ROWS = 20_000
PAIRS, STEPS = 40_000, 400
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero without a word."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * N_FEATURES
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    digits, high = int(count[48:58].sum()), int(count[128:].sum())
    blank = int(count[9:14].sum() + count[32])
    n, solid = len(words), len(data) - blank
    lines = [line for line in data.split(b"\n") if line.strip()]
    distinct = len(set(words)) / n
    repeats = sum(map(eq, words, words[1:])) / n
    base = [
        math.log(n),
        distinct,
        distinct * math.log(n),
        repeats,
        upper / (upper + lower + 1),
        digits / solid,
        high / solid,
        int(count[_SYMBOLS].sum()) / solid,
        int(count[33]) / solid,
        int(count[124]) / solid,
        (solid - upper - lower - digits - high) / solid,
        solid / n,
        max(map(len, words)) / (solid / n),
        1 - len(set(lines)) / len(lines),
        math.log(n / len(lines)),
        int(count[46] + count[44]) / n,
    ]
    return base + [math.sqrt(x) for x in base[3:11]]


N_FEATURES = 24


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking: standardisation, weights and the margin at the cutoff score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -5, 5)
        return z @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shifted = self.margin(x) - self.cut + math.log(CUTOFF / (1 - CUTOFF))
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


def fit_ranking(x: np.ndarray, quality: np.ndarray, seed: int = 0) -> Ranking:
    """Learn weights by which preferred rows outscore others, and the cut.

    Every step draws pairs of a row of quality 1 and one of quality 0 and lowers the logistic
    loss of their score difference. The cut is the quantile of the scores, at most the share of
    quality 0 twice over, that tells the two apart best. With one quality only, or no rows,
    every text scores alike, above the cutoff.
    """
    n = x.shape[1]
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(n), np.ones(n), np.zeros(n), -1.0)
    centre, scale = x[good].mean(axis=0), x[good].std(axis=0)
    scale = np.maximum(scale, 0.2 * x.std(axis=0)) + 1e-9
    z = np.clip((x - centre) / scale, -5, 5)
    rng = np.random.default_rng(seed)
    w, first, second = np.zeros(n), np.zeros(n), np.zeros(n)
    for step in range(1, STEPS + 1):
        size = min(PAIRS, 16 * len(quality)) // 8 + 1
        diff = z[rng.choice(good, size)] - z[rng.choice(bad, size)]
        lost = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        gradient = -(lost @ diff) / size + 1e-3 * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    scores = z @ w
    order = np.argsort(scores, kind="stable")
    # Right decisions when the k lowest are rejected, for every k.
    right = np.concatenate([[0], np.cumsum(1 - quality[order])]) + np.concatenate(
        [np.cumsum(quality[order][::-1])[::-1], [0]]
    )
    k = int(np.argmax(right[: min(len(order) - 1, 2 * len(bad)) + 1]))
    ranked = scores[order]
    cut = (ranked[k - 1] + ranked[k]) / 2 if k else ranked[0] - 1
    return Ranking(centre, scale, w, float(cut))


def held_out(doc_id: Column) -> Column:
    """True where labels must not be learned from; a null id counts as text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train_ranking(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on the labelled rows that are not held out, at most SAMPLE_ROWS labels.

    Repeated labels count once, and so do rows of a repeated doc_id, with the smallest features
    of their texts. So SAMPLE_ROWS short rows at most reach the driver.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .filter(~held_out(F.col("doc_id")))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(SAMPLE_ROWS)
    )

    @pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")  # SAMPLE_ROWS rows at most
        .select("doc_id", "quality", described("text").alias("x"))
        .groupBy("doc_id", "quality")
        .agg(F.min("x").alias("x"))
        .toPandas()
        .sort_values(["doc_id", "quality"], kind="stable")
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), N_FEATURES)
    return fit_ranking(x, rows["quality"].to_numpy(dtype=int))


def score_quality(docs: DataFrame, ranking: Ranking, name: str = "score") -> DataFrame:
    """All rows and columns of ``docs``, with the score (0 to 1) of their whole text as ``name``.

    Null and empty texts are scored like texts without a word. A column of that name is replaced.
    """

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], float).reshape(-1, N_FEATURES)
            yield pd.Series(ranking.score(x))

    return docs.withColumn(name, scored(F.col("text")))


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = train_ranking(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, ranking).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= CUTOFF, 1).otherwise(0).alias("predicted"),
    )
