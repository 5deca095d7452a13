"""Language-model scores of whole documents, from corpus counts and a recurrent network."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridmargin.llm import gru
from gridmargin.llm.common import stored, table
from gridmargin.llm.simhash import words_of

END = ""  # no word is empty
# Documents that are read side by side in training.
LANES = 128
# One in so many training documents is kept aside, to choose how far the training goes.
CHECKED = 16
STEPS = (0.0, 0.5, 1.0)
# Weights of so many parts are averaged in one group.
FAN = 16
# Tail words that the tail classes are clustered from, the most frequent ones.
CLUSTER_WORDS = 20_000
BLOCK_BYTES = 20_000_000
_PAIRS = 64


def spelling(words: list[str]) -> np.ndarray:
    """Unit vectors of hashed pairs of neighbouring bytes, the word's ends included."""
    out = np.zeros((len(words), _PAIRS), np.float32)
    for at in range(0, len(words), 20_000):
        some = [b"^" + w.encode() + b"$" for w in words[at : at + 20_000]]
        lengths = np.array([len(w) for w in some])
        codes = np.frombuffer(b"".join(some), np.uint8).astype(np.uint32)
        pair = ((codes[:-1] * 40503 + codes[1:] * 60493) * np.uint32(2654435761)) >> np.uint32(26)
        owner = np.repeat(np.arange(len(some)), lengths)
        inside = owner[:-1] == owner[1:]
        flat = np.bincount(owner[:-1][inside] * _PAIRS + pair[inside], minlength=len(some) * _PAIRS)
        out[at : at + len(some)] = flat.reshape(-1, _PAIRS)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def cluster(vectors: np.ndarray, weights: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centres of ``k`` groups of unit vectors by weighted k-means; zeros without vectors."""
    centres = np.zeros((k, vectors.shape[1]), np.float32)
    if len(vectors):
        rng = np.random.default_rng(seed)
        centres = vectors[rng.choice(len(vectors), k, p=weights / weights.sum())].copy()
        for _ in range(12):
            nearest = (vectors @ centres.T).argmax(axis=1)
            for c in range(k):
                if (mine := nearest == c).any():
                    centre = weights[mine] @ vectors[mine]
                    centres[c] = centre / max(np.linalg.norm(centre), 1e-9)
    return centres


class Vocabulary:
    """Inputs of words: head slots by rank (the end token first), tail classes by spelling."""

    def __init__(self, head: list[str], centres: np.ndarray) -> None:
        self.slots = {w: i for i, w in enumerate([END, *head])}
        self.centres = centres

    def inputs(self, words: list[str]) -> dict[str, int]:
        """The input of each of some distinct words."""
        tail = [w for w in words if w not in self.slots]
        found = {w: self.slots[w] for w in words if w in self.slots}
        if tail:
            classes = (spelling(tail) @ self.centres.T).argmax(axis=1) + gru.HEAD
            found.update(zip(tail, classes.tolist(), strict=True))
        return found


def held_out(doc_id: Column) -> Column:
    """True where a document must not be learned from; a null id counts as text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all ``docs``, the end token of each included."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch["text"]:
                counts.update(words_of(text))
            counts[b""] += len(batch)
            yield pd.DataFrame(
                {"word": [w.decode() for w in counts], "c": np.array(list(counts.values()), np.int64)}
            )

    return (
        docs.select("text").mapInPandas(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    )


def checked() -> Column:
    """True where training documents only choose between weights; equal texts go together."""
    return F.pmod(F.xxhash64("inputs"), F.lit(CHECKED)) == 0


def train_blocks(profiles: DataFrame, start: gru.Parameters, blocks: int) -> DataFrame:
    """(part, tokens, weights): weights that each block's training documents lead to.

    One optimiser per block, one pass over its documents in an order of their own, so that
    weights depend on the table alone, not on its files or batches.
    """
    flat = start.flat

    def local(part: pd.DataFrame) -> pd.DataFrame:
        docs = [np.frombuffer(x, "<i2").astype(np.int64) for x in part["inputs"]]
        p, tokens = gru.train(gru.Parameters(flat), docs, lanes=LANES)
        return pd.DataFrame(
            {"part": [part["block"].iloc[0]], "tokens": [tokens], "weights": [p.flat.astype(float).tobytes()]}
        )

    return (
        profiles.filter(~checked())
        .select("block", "inputs")
        .repartition(blocks, "block")  # a number, as small blocks take long, too
        .groupBy("block")
        .applyInPandas(local, "part int, tokens long, weights binary")
    )


def average(parts: DataFrame, number: int) -> tuple[int, np.ndarray | None]:
    """Tokens and mean weights, by tokens, of ``number`` parts at most, merged in a tree."""

    def merge(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("part")
        total = int(some["tokens"].sum())
        mean = np.zeros(gru.SIZE)
        for tokens, weights in zip(some["tokens"], some["weights"], strict=True):
            mean += np.frombuffer(weights) * (tokens / total)
        return pd.DataFrame(
            {"part": [some["part"].iloc[0] // FAN], "tokens": [total], "weights": [mean.tobytes()]}
        )

    while number > 1:
        number = math.ceil(number / FAN)
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(
            merge, "part int, tokens long, weights binary"
        )
    found = parts.first()  # the only row
    return (found["tokens"], np.frombuffer(found["weights"])) if found else (0, None)


def train_network(profiles: DataFrame, start: gru.Parameters, blocks: int) -> gru.Parameters:
    """Weights learned from training documents (block, inputs): trained by block and averaged.

    All documents are read, at every size. Those of :func:`checked` choose how far to go from
    ``start`` to the average, so that few documents can't make the network worse than the
    counts it starts from. Without any of them ``start`` stays.
    """
    _, mean = average(train_blocks(profiles, start, blocks), blocks)
    if mean is None:
        return start
    first = start.flat.astype(float)
    steps = [(first + step * (mean - first)).astype(np.float32) for step in STEPS]

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs = [np.frombuffer(x, "<i2") for x in batch["inputs"]]
            logs = [gru.log_likelihoods(gru.Parameters(w), docs).sum() for w in steps]
            yield pd.DataFrame({"step": range(len(steps)), "logs": logs})

    sums = (
        profiles.filter(checked())
        .select("inputs")
        .mapInPandas(check, "step int, logs double")
        .groupBy("step")
        .agg(F.sum("logs").alias("logs"))
        .orderBy(F.desc("logs"), "step")
        .first()
    )
    return gru.Parameters(steps[sums["step"]]) if sums else start


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Scores are log10 probabilities of the whole text with its end. Null and empty texts are
    the end token alone. A null doc_id is a document like any other; repeated rows are counted
    and scored each. Without training documents all words are unseen and base_score is 0.
    Other columns are ignored. Scores do not depend on how the table is cut into partitions,
    but for rounding of single precision.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
    training = docs.filter(~F.col("held_out"))
    counts = stored(word_counts(training), "word-counts")
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = totals[0] or 0, totals[1]

    frequent = (
        counts.filter(F.col("word") != END)
        .orderBy(F.desc("c"), "word")
        .limit(gru.HEAD - 1 + CLUSTER_WORDS)
        .toPandas()
    )
    head = frequent.head(gru.HEAD - 1)
    rest = frequent.iloc[gru.HEAD - 1 :]
    ends = counts.filter(F.col("word") == END).select("c").first()
    centres = cluster(
        spelling(rest["word"].tolist()), rest["c"].to_numpy(dtype=float), gru.TAIL_CLASSES
    )
    vocabulary = Vocabulary(head["word"].tolist(), centres)

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = vocabulary.inputs(batch["word"].tolist())
            yield batch.assign(input=[found[w] for w in batch["word"]])

    counts = stored(counts.mapInPandas(classify, "word string, c long, input int"), "word-inputs")
    tail = F.col("input") - gru.HEAD
    tails = (
        counts.filter(tail >= 0)
        .groupBy(tail.alias("tail"))
        .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds"))
        .toPandas()
        .set_index("tail")
        .reindex(range(gru.TAIL_CLASSES), fill_value=0)
    )
    tail_c, tail_kinds = tails["c"].to_numpy(dtype=float), tails["kinds"].to_numpy(dtype=float)
    start = gru.initial(
        np.array([ends["c"] if ends else 0.5, *head["c"]], dtype=float), tail_c
    )

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    laid_out = docs.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    ).repartition(blocks, "block")

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, texts in batch.groupby("block")["text"]:
                words: set = set().union((b"",), *map(words_of, texts))
                yield pd.DataFrame({"word": [w.decode() for w in words], "block": block})

    # All columns go in, so that both readers of the layout share one shuffle of the texts.
    lookups = (
        laid_out.mapInPandas(distinct, "word string, block int")
        .distinct()
        .join(counts, "word")
        .select("block", F.col("word").cast("binary").alias("word"), "c", "input")
    )

    def profile(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        numbers = {bytes(w): i for i, w in enumerate(known["word"])}
        rows = []
        for text in part["text"]:
            rows.append(
                np.array([numbers.setdefault(w, len(numbers)) for w in (*words_of(text), b"")], np.int32)
            )
        unseen = [w.decode() for w in list(numbers)[len(known) :]]
        found = vocabulary.inputs(unseen)
        c = np.concatenate([known["c"].to_numpy(dtype=float), np.zeros(len(unseen))])
        inputs = np.concatenate([known["input"].to_numpy(), [found[w] for w in unseen]]).astype("<i2")
        base = np.log10(c + 0.5) - math.log10(n + 0.5 * (v + 1))
        tail = np.maximum(inputs - gru.HEAD, 0)
        share = np.where(
            inputs < gru.HEAD, 0, np.log((c + 0.5) / (tail_c[tail] + 0.5 * (tail_kinds[tail] + 1)))
        )
        return pd.DataFrame(
            {
                "block": part["block"],
                "doc_id": part["doc_id"].astype("Int64"),
                "held_out": part["held_out"],
                "n_tokens": [len(r) for r in rows],
                "n_known": [int((c[r] > 0).sum()) for r in rows],
                "base_score": [base[r].sum() for r in rows],
                "share": [share[r].sum() for r in rows],
                "inputs": [inputs[r].tobytes() for r in rows],
            }
        )

    profiles = stored(
        laid_out.groupBy("block")
        .cogroup(lookups.groupBy("block"))
        .applyInPandas(
            profile,
            "block int, doc_id long, held_out boolean, n_tokens long, n_known long, "
            "base_score double, share double, inputs binary",
        ),
        "profiles",
    )
    flat = train_network(profiles.filter(~F.col("held_out")), start, blocks).flat

    @pandas_udf("double")
    def score(inputs: pd.Series, share: pd.Series) -> pd.Series:
        logs = gru.log_likelihoods(gru.Parameters(flat), [np.frombuffer(x, "<i2") for x in inputs])
        return (pd.Series(logs) + share) / math.log(10)

    return profiles.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        score("inputs", "share").alias("score"),
    )


def op10_gated_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and network scores of every document."""
    return score_documents(table(spark, sf_dir, "documents"))
