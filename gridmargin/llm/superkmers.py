"""Repeated word windows, removed by super-k-mer partitioning.

Consecutive windows with one minimiser form a super-k-mer. It travels as one packed string,
equal ones are combined on the way, and where different ones meet at a minimiser their
windows are laid out and sorted to tell exactly which occur more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.llm.common import table
from gridmargin.llm.minimisers import (
    Windows,
    distinct_runs,
    keyed,
    mixed_buckets,
    packed_runs,
    repeated_runs,
)

M_WORDS = 4
# Words of different super-k-mers in one bucket that one task sorts. The windows of a larger
# bucket are laid out and counted by Spark instead.
BUCKET_WORDS = 1 << 19


def _repeats_in_bucket(
    bucket: dict[tuple[int, int], tuple[int, bytes]], k: int
) -> Iterator[tuple[int, int]]:
    """(row, start) of the windows of a bucket that are equal to an earlier one.

    ``bucket`` has doc_id and packed string by row and start. All windows are laid out and sorted by their
    words, then by document and place, so that the first of equals leads them.
    """
    laid_out = []
    for (row, start), (doc_id, packed) in bucket.items():
        words = packed.split(b" ")
        laid_out += [
            (b" ".join(words[j : j + k]), doc_id, row, start + j) for j in range(len(words) - k + 1)
        ]
    laid_out.sort()
    for (before, *_), (window, _, row, start) in zip(laid_out, laid_out[1:], strict=False):
        if window == before:
            yield row, start


def later_windows(docs: DataFrame, k: int, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(row, start, n): n windows from word ``start`` whose words also start earlier.

    Earlier is a smaller doc_id (null counts as the smallest), or an earlier start in the same
    document. ``docs`` is that of :func:`keyed`.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket: dict[tuple[int, int], tuple[int, bytes]] = {}
        last = None
        out: list[tuple[int, int]] = []
        for batch in batches:
            ids = [-(1 << 64) if i is pd.NA else i for i in batch["doc_id"].astype("Int64")]
            columns = (batch[c].tolist() for c in ("mini", "row", "start", "packed"))
            for mini, row, start, packed, doc_id in zip(*columns, ids, strict=True):
                if mini != last:
                    out += _repeats_in_bucket(bucket, k)
                    bucket, last = {}, mini
                bucket[row, start] = doc_id, packed  # once, however often a row repeats
            yield pd.DataFrame(out, columns=["row", "start"], dtype="int64")
            out = []
        out += _repeats_in_bucket(bucket, k)
        yield pd.DataFrame(out, columns=["row", "start"], dtype="int64")

    windows = Windows(k, min(M_WORDS, 1 << (k.bit_length() - 1)), True)
    occurrences = repeated_runs(docs, windows)
    distinct = distinct_runs(occurrences)
    one = F.lit(1).cast("long")
    # A later copy of a whole super-k-mer repeats with all its windows.
    copies = (
        occurrences.join(
            distinct.filter("copied").select("mini", "key", "first"), ["mini", "key"]
        )
        .filter(F.struct("doc_id", "row", "start") != F.col("first"))
        .select("row", "start", "n")
    )
    met = distinct.join(mixed_buckets(distinct, k), "mini")
    small, large = F.col("units") <= bucket_words, F.col("units") > bucket_words
    scanned = (
        packed_runs(docs, met.filter(small), windows)
        .repartition("mini")
        .sortWithinPartitions("mini")
        .mapInPandas(scan, "row long, start long")
        .select("row", "start", one.alias("n"))
    )
    words = F.split(F.col("packed").cast("string"), " ")
    laid_out = (
        packed_runs(docs, met.filter(large), windows)
        .dropDuplicates(["mini", "key"])
        .select("doc_id", "row", "start", words.alias("words"))
        .select(
            "doc_id",
            "row",
            "start",
            "words",
            F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("j"),
        )
        .select(
            F.array_join(F.slice("words", F.col("j") + 1, k), " ").alias("window"),
            F.struct("doc_id", "row", (F.col("start") + F.col("j")).alias("start")).alias("at"),
        )
    )
    counted = (
        laid_out.groupBy("window")
        .agg(F.count(F.lit(1)).alias("times"), F.min("at").alias("first"))
        .filter("times > 1")
    )
    singles = (
        laid_out.join(counted, "window")
        .filter("at <> first")
        .select("at.row", "at.start", one.alias("n"))
    )
    return copies.unionAll(scanned).unionAll(singles)


def spans_of(starts: np.ndarray, counts: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of ``total`` units some window covers, given windows start, start + 1, ..."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + counts + k - 1, total), -1)
    return np.cumsum(edge[:total]) > 0


def with_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``docs`` with the arrays ``starts`` and ``counts`` of their windows, null without any.

    Windows of rows that repeat are combined before they are sent and count once.
    """
    per_row = (
        windows.groupBy("row")
        .agg(F.collect_set(F.struct("start", "n")).alias("runs"))
        .select("row", F.col("runs.start").alias("starts"), F.col("runs.n").alias("counts"))
    )
    return docs.join(per_row, "row", "left")


def remove_repeated_words(docs: DataFrame, k: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without the words of later windows.

    ``kept`` joins the words left by one space. Windows are judged on the input. Null and
    empty texts have no words, texts under ``k`` words no window. Rows with the same doc_id
    and text count as one document and get one result each; rows with the same doc_id and
    different texts are different documents. Other columns are ignored.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, starts, counts in zip(
                *(batch[c] for c in ("doc_id", "text", "starts", "counts")), strict=True
            ):
                words = text.encode().split()
                gone = 0
                if starts is not None:
                    covered = spans_of(np.array(starts), np.array(counts), k, len(words))
                    gone = int(covered.sum())
                    kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                else:
                    kept = words
                out.append((doc_id, len(words), gone, b" ".join(kept)))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "n_words", "n_removed", "kept"]
    docs = keyed(docs)
    return (
        with_windows(docs, later_windows(docs, k))
        .select("doc_id", "text", "starts", "counts")
        .mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept binary")
    )


def op5_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier elsewhere."""
    left = remove_repeated_words(table(spark, sf_dir, "documents"), 20)
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
