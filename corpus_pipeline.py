"""A training corpus from raw documents: five stages, each kept as Parquet for the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridmargin.llm.common import stored, table
from gridmargin.llm.minimisers import keyed
from gridmargin.llm.mixing import mix_documents
from gridmargin.llm.packing import default_tokenizer, pack_power_of_two
from gridmargin.llm.quality import CUTOFF, score_quality, train_ranking
from gridmargin.llm.simhash import without_near_copies
from gridmargin.llm.suffixes import repeated_bytes
from gridmargin.llm.superkmers import spans_of, with_windows

# Substrings of so many bytes that occur more than once go.
REPEAT_BYTES = 200
# Texts reach Python in batches of some so many bytes, as 10,000 long ones would fill a worker.
BATCH_BYTES = 8 << 20
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """``stage`` with batches of BATCH_BYTES; the session keeps that setting."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cutoff."""
    ranking = train_ranking(docs, table(spark, sf_dir, "labels"))
    whole = docs.select("text", F.struct(*docs.columns).alias("doc"))
    return score_quality(whole, ranking, "score").filter(F.col("score") >= CUTOFF).select("doc.*")


@bounded
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by SimHash of three-word shingles, two bits."""
    return without_near_copies(docs, width=3, radius=2)


@bounded
def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without substrings of 200 bytes that start anywhere else, too, as `op8` has it.

    No occurrence stays, the first neither: what so many texts share is boilerplate. Only whole characters go. A document that had text and keeps none goes as well; n_chars
    is that of the text left. Null texts stay null.
    """

    @pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([_without(*row) for row in zip(texts, starts, counts, strict=True)], dtype=object)

    # Else the filter below would be pushed under it, with a call and Python workers of its own.
    cleaned = cut.asNondeterministic()
    windows = stored(repeated_bytes(keyed(docs), REPEAT_BYTES), "repeated-windows")
    # Under numbered names no column can clash with those of the operator.
    numbered = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    whole = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("row"),
        *[F.col(c).alias(n) for c, n in numbered.items()],
    )
    text = numbered["text"]
    touched = with_windows(whole, windows).select(
        F.col("starts").isNotNull().alias("touched"),
        *[n for n in numbered.values() if n != text],
        cleaned(text, "starts", "counts").alias(text),
    )
    new = {c: F.col(n) for c, n in numbered.items()}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("touched"), F.length(text).cast("long")).otherwise(new["n_chars"])
    return touched.filter(~F.col("touched") | (F.length(F.trim(text)) > 0)).select(
        *[column.alias(c) for c, column in new.items()]
    )


def _without(text: str | None, starts: np.ndarray | None, counts: np.ndarray | None) -> str | None:
    """A text without the characters that lie whole in its repeated substrings."""
    if starts is None:
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    gone = spans_of(np.array(starts), np.array(counts), REPEAT_BYTES, len(data))
    first = np.flatnonzero((data & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, first)
    return data[~np.repeat(whole, np.diff(np.append(first, len(data))))].tobytes().decode()


@bounded
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents that meets the target shares of sources, languages, topics."""
    whole = docs.select("doc_id", "text", "lang", "source", F.struct(*docs.columns).alias("_doc"))
    return mix_documents(whole).filter("kept").select("_doc.*")


@bounded
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, cut into power-of-two sequences of token ids."""
    return pack_power_of_two(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_text", repeated_text),
    ("mixing", mixing),
    ("packing", packing),
]
ORACLE_SQL = None  # SQL expresses neither the trained stages nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
