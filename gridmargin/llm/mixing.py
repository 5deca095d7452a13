"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell of source, language and topic. Raking scales the cells in turn so
that the weighted tokens meet the target share of every source, language and topic; documents
are then kept with probabilities in proportion to the weights of their cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridmargin.llm.common import checkpointed, stored, table
from gridmargin.llm.lm_scoring import cluster
from gridmargin.llm.simhash import words_of

DIMENSIONS = ("source", "lang", "topic")
TOPICS, WORD_SLOTS = 8, 256
# Most documents that the first centres are drawn from, those with the smallest hash.
START_SAMPLE = 3_000
# Rounds of k-means over all documents.
TOPIC_ROUNDS = 4
# A value's target is its share of the tokens to this power: large ones shrink, small ones grow.
TEMPER = 0.7
# Expected share of the tokens that is kept.
KEPT_SHARE = 0.7
# Most rounds of raking; it stops once all marginals are within TOLERANCE of their targets.
ROUNDS = 20
TOLERANCE = 1e-9
# Vectors are added up in multiples of 1 / _UNIT, so that sums don't depend on the order.
_UNIT = 1 << 24


def word_profile(words: list[bytes]) -> np.ndarray:
    """Unit vector of the square roots of hashed word counts; zero without words."""
    slots = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words)) % WORD_SLOTS
    counts = np.sqrt(np.bincount(slots, minlength=WORD_SLOTS))
    return (counts / max(np.linalg.norm(counts), 1e-9)).astype(np.float32)


def residual(profiles: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Unit vectors of profiles relative to means; zero where they are equal."""
    vectors = profiles - means
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fixed(vectors: np.ndarray) -> np.ndarray:
    """The sum of vectors, each rounded to multiples of 1 / _UNIT, in these units."""
    return np.rint(vectors.astype(float) * _UNIT).astype(np.int64).sum(axis=0)


def _summed(rows: DataFrame, key: str) -> tuple[list, np.ndarray, np.ndarray]:
    """Values of ``key`` in order, and per value the sums of ``n`` and of the arrays ``total``.

    ``total`` holds what :func:`fixed` gives; the sums are exact and come back as numbers.
    """
    found = (
        rows.select(key, F.posexplode(F.concat(F.array("n"), "total")))
        .groupBy(key, "pos")
        .agg(F.sum("col").alias("sum"))
        .toPandas()
        .pivot(index=key, columns="pos", values="sum")
        .sort_index()
    )
    sums = found.to_numpy(dtype=float).reshape(-1, 1 + WORD_SLOTS)
    return found.index.tolist(), sums[:, 0], sums[:, 1:] / _UNIT


def topic_centres(docs: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(means, centres) of the word profiles of all documents with text.

    Profiles are taken relative to the mean of their language, so that topics are not
    languages over again; '' has the mean of documents without a language, of all if there
    are none. Batches send sums, Spark adds them, and a few rounds of k-means read all documents
    each. Only the first centres come from a bounded sample. The result follows from the rows
    alone, not from their files, batches or order.
    """
    key = F.xxhash64("doc_id", "text").alias("key")
    worded = docs.filter(F.length("text") > 0).select(
        key, "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    )

    def profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [word_profile(words_of(t)) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "lang": batch["lang"], "profile": found})

    profiled = stored(
        worded.mapInPandas(profiles, "key long, lang string, profile array<float>"), "profiles"
    )

    def by_language(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, some in batch.groupby("lang")["profile"]:
                total = fixed(np.stack(some.to_numpy()))
                yield pd.DataFrame({"lang": [lang], "n": [len(some)], "total": [total]})

    langs, counts, totals = _summed(
        profiled.mapInPandas(by_language, "lang string, n long, total array<long>"), "lang"
    )
    whole = totals.sum(axis=0) / max(counts.sum(), 1)
    means = {"": whole.astype(np.float32)}
    for lang, total, count in zip(langs, totals, counts, strict=True):
        means[lang] = (total / count).astype(np.float32)

    # Keys are sorted without their profiles, so that no task reads more than keys.
    chosen = profiled.select("key").distinct().orderBy("key").limit(START_SAMPLE)
    sample = profiled.join(F.broadcast(chosen), "key", "left_semi").dropDuplicates(["key"])
    start = sorted((r["lang"], tuple(r["profile"])) for r in sample.drop("key").collect())
    vectors = np.array([p for _, p in start], np.float32).reshape(-1, WORD_SLOTS)
    if len(vectors):
        vectors = residual(vectors, np.array([means[lang] for lang, _ in start]))
    centres = cluster(vectors, np.ones(len(vectors)), TOPICS)

    for _ in range(TOPIC_ROUNDS if len(vectors) else 0):

        def by_topic(batches: Iterator[pd.DataFrame], centres=centres) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                found = residual(
                    np.stack(batch["profile"].to_numpy()), np.array([means[x] for x in batch["lang"]])
                )
                # Unlike a matrix product, this gives a row the same in any batch.
                nearest = np.einsum("ij,kj->ik", found, centres).argmax(axis=1)
                for topic in np.unique(nearest):
                    mine = found[nearest == topic]
                    total = fixed(mine)
                    yield pd.DataFrame({"topic": [topic], "n": [len(mine)], "total": [total]})

        topics, _, moved = _summed(
            profiled.mapInPandas(by_topic, "topic int, n long, total array<long>"), "topic"
        )
        centres = centres.copy()
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-9)
        centres[topics] = moved.astype(np.float32)
    return means, centres


def with_facts(docs: DataFrame, centres: tuple[dict[str, np.ndarray], np.ndarray]) -> DataFrame:
    """``docs`` with the column ``facts``: source and lang ('' for null), topic and tokens."""
    means, groups = centres

    @pandas_udf("topic int, tokens long")
    def measured(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        topics, tokens = [], []
        for text, lang in zip(texts, langs, strict=True):
            words = words_of(text)
            mean = means.get(lang or "", means[""])
            topics.append(int((groups @ (word_profile(words) - mean)).argmax()))
            tokens.append(len(words))
        return pd.DataFrame({"topic": topics, "tokens": tokens})

    seen = docs.withColumn("_measured", measured(F.col("text"), F.col("lang").cast("string")))
    return seen.withColumn(
        "facts",
        F.struct(
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
            F.col("_measured.topic").alias("topic"),
            F.col("_measured.tokens").alias("tokens"),
        ),
    ).drop("_measured")


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> dict[str, DataFrame]:
    """(value, share) per dimension: shares of the tokens to the power ``temper``, made 1 again."""
    targets = {}
    for name in DIMENSIONS:
        sums = (
            cells.groupBy(F.col(name).alias("value"))
            .agg(F.sum("tokens").alias("tokens"))
            .select("value", F.pow(F.col("tokens"), temper).alias("part"))
        )
        whole = sums.agg(F.sum("part")).first()[0] or 1.0
        targets[name] = checkpointed(sums.select("value", (F.col("part") / whole).alias("share")))
    return targets


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: weighted tokens have the target shares of all dimensions.

    The cells are aggregated beforehand: what a window holds are distinct combinations of
    values, not documents. Every few rounds the plan is cut by a checkpoint, and raking ends if
    the weights meet all targets by then.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    weighted = cells.withColumn("weight", F.lit(1.0))
    for name in DIMENSIONS:
        wanted = targets[name].select(F.col("value").alias(name), F.col("share").alias(f"_{name}"))
        weighted = weighted.join(wanted, name)
    for round_ in range(rounds):
        for name in DIMENSIONS:
            current = F.sum(F.col("weight") * F.col("tokens")).over(Window.partitionBy(name))
            weighted = weighted.withColumn(
                "weight", F.col("weight") * F.col(f"_{name}") * total / current
            )
        if round_ % 5 == 4:
            weighted = checkpointed(weighted)
            goals = {name: F.first(f"_{name}") * total for name in DIMENSIONS}
            if largest_gap(weighted, F.col("weight") * F.col("tokens"), goals) <= TOLERANCE:
                break
    return weighted.select(*cells.columns, "weight")


def largest_gap(cells: DataFrame, amount: Column, goals: dict[str, Column]) -> float:
    """How far, relative to its goal, the sum of ``amount`` of any value is from that goal."""
    gaps = [
        cells.groupBy(name).agg((F.sum(amount) / goal - 1).alias("gap")).select(F.abs("gap").alias("gap"))
        for name, goal in goals.items()
    ]
    return reduce(DataFrame.unionAll, gaps).agg(F.max("gap")).first()[0] or 0.0


def achieved_shares(chances: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(dimension, value, tokens, target, achieved) of cells with their ``probability``.

    ``target`` is the wanted share of the kept tokens, ``achieved`` the expected one. A value
    that falls short is kept whole or has too few cells that could give more.
    """
    expected = F.col("tokens") * F.col("probability")
    whole = chances.agg(F.sum(expected)).first()[0] or 1.0
    parts = [
        chances.groupBy(F.col(name).cast("string").alias("value"))
        .agg(F.sum("tokens").alias("tokens"), (F.sum(expected) / whole).alias("achieved"))
        .join(targets[name].select(F.col("value").cast("string").alias("value"), F.col("share").alias("target")), "value")
        .select(F.lit(name).alias("dimension"), "value", "tokens", "target", "achieved")
        for name in DIMENSIONS
    ]
    return reduce(DataFrame.unionAll, parts)


def kept_scale(cells: DataFrame, share: float) -> float:
    """The factor s for which min(1, s weight) keeps ``share`` of the tokens."""
    low, high = 1e-6, 1e6
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for _ in range(3):
        scales = np.geomspace(low, high, 65)
        kept = cells.agg(
            *[
                F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * float(s))).alias(f"s{i}")
                for i, s in enumerate(scales)
            ]
        ).first()
        over = [i for i in range(65) if (kept[i] or 0) >= share * total]
        at = max(1, over[0]) if over else 64
        low, high = scales[at - 1], scales[at]
    return float(high)


def attainable(cells: DataFrame, wanted: DataFrame, name: str, share: float) -> DataFrame:
    """(name, target): the tokens of each value that ``share`` of all should keep.

    A value whose target is more than it has keeps all, the others share the rest by their targets.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    values = checkpointed(
        cells.groupBy(name).agg(F.sum("tokens").alias("tokens"))
        .join(wanted.select(F.col("value").alias(name), "share"), name)
        .withColumn("weight", F.col("share") * total / F.col("tokens"))
    )
    scale = kept_scale(values, share)
    return values.select(
        name, (F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * scale)).alias(f"_{name}")
    )


def bounded(
    weighted: DataFrame, targets: dict[str, DataFrame], share: float, rounds: int = ROUNDS
) -> DataFrame:
    """``weighted`` with ``probability``: raked again with the bound of 1 in place.

    What the cells that are kept whole can't give comes from the others of their value.
    """
    raked = weighted.withColumn("_p", F.col("weight") * kept_scale(weighted, share))
    for name in DIMENSIONS:
        raked = raked.join(attainable(weighted, targets[name], name, share), name)
    for round_ in range(rounds):
        for name in DIMENSIONS:
            value = Window.partitionBy(name)
            whole = F.sum(F.when(F.col("_p") >= 1, F.col("tokens")).otherwise(0)).over(value)
            part = F.sum(F.when(F.col("_p") < 1, F.col("_p") * F.col("tokens")).otherwise(0.0)).over(value)
            target = F.col(f"_{name}")
            factor = F.when((target > whole) & (part > 0), (target - whole) / part).otherwise(
                F.least(F.lit(1.0), target / (whole + part))
            )
            raked = raked.withColumn("_p", F.col("_p") * factor)
        if round_ % 5 == 4:
            raked = checkpointed(raked)
            goals = {name: F.first(f"_{name}") for name in DIMENSIONS}
            kept = F.col("tokens") * F.least(F.lit(1.0), "_p")
            if largest_gap(raked, kept, goals) <= TOLERANCE:
                break
    return raked.select(*weighted.columns, F.least(F.lit(1.0), "_p").alias("probability"))


def mix_documents(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = KEPT_SHARE
) -> DataFrame:
    """``docs`` with ``facts`` (source, lang, topic, tokens), ``weight``, ``probability`` and ``kept``.

    Targets default to :func:`tempered_targets`. Whether a document is kept follows from a hash
    of its doc_id and text, so repeated rows share their fate. Null source or language count as
    ''; texts without words weigh nothing in the targets and have their cell's probability, or 1
    where a whole source, language or topic has no word.
    """
    measured = with_facts(docs, topic_centres(docs))
    cells = stored(
        measured.groupBy(*[F.col(f"facts.{n}").alias(n) for n in DIMENSIONS]).agg(
            F.sum("facts.tokens").alias("tokens")
        ),
        "cells",
    )
    full = cells.filter("tokens > 0")
    targets = targets or tempered_targets(full)
    weighted = stored(rake(full, targets), "weights")
    chances = stored(bounded(weighted, targets, share), "chances").select(
        *[F.col(n).alias(f"_{n}") for n in DIMENSIONS], "weight", "probability"
    )
    match = reduce(
        lambda a, b: a & b, [F.col(f"facts.{n}") == F.col(f"_{n}") for n in DIMENSIONS]
    )
    return (
        measured.drop("weight", "probability", "kept")
        .join(chances, match, "left")
        .drop(*[f"_{n}" for n in DIMENSIONS])
        .fillna(1.0, ["weight", "probability"])
        .withColumn("kept", draw(F.col("doc_id"), F.col("text")) < F.col("probability"))
    )


def draw(*keys: Column) -> Column:
    """A number in [0, 1) that follows from ``keys``."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit("mix")), 11).cast("double") / float(1 << 53)


def op4_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, probability and draw of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix_documents(docs).select(
        "doc_id", "facts.source", "facts.lang", "facts.topic", F.col("facts.tokens").alias("n_tokens"),
        "weight", "probability", "kept",
    )
