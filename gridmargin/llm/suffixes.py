"""Repeated substrings, found by the common-prefix intervals of an enhanced suffix array.

Runs of byte windows that share a minimiser meet in its bucket. There the strings' suffixes
are sorted, a stack scans the common prefixes of neighbours, and every interval whose
occurrences differ in the byte before them is a maximal repeat with all its occurrences.
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
from gridmargin.llm.superkmers import spans_of, with_windows

M_BYTES = 32
# Bytes of distinct strings in one bucket that one suffix array takes. A larger bucket is
# dealt with window by window instead, which no single task has to hold.
BUCKET_BYTES = 4 << 20
_BATCH = 1 << 19


def suffix_array(strings: list[bytes], k: int) -> tuple[np.ndarray, ...]:
    """Enhanced suffix array of ``strings`` over suffixes of at least ``k`` bytes.

    Returns their sorted places in the joined text, the common prefix of each with the one
    before it, the byte before each (distinct negative numbers at a string's start), the
    number of its string and the place where that starts. No prefix crosses strings.
    """
    lengths = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(lengths) - 1
    codes = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + len(strings)
    codes[ends] = np.arange(len(strings))  # every string ends with a sign of its own
    n, size, ranks = len(codes), 1, [codes.astype(np.int32)]
    while size < lengths.max():
        ahead = np.zeros(n, np.int64)
        ahead[: n - size] = ranks[-1][size:]
        ahead[: n - size] += 1
        last = ranks[-1].astype(np.int64)
        rank = np.unique(last * (int(last.max()) + 2) + ahead, return_inverse=True)[1]
        ranks.append(rank.astype(np.int32))
        size *= 2
        if rank.max() == n - 1:
            break
    number = np.repeat(np.arange(len(strings)), lengths)
    starts = ends - lengths + 1
    places = np.flatnonzero(np.arange(n) + k <= ends[number])
    places = places[np.argsort(ranks[-1][places], kind="stable")]
    left, right = places[:-1].copy(), places[1:].copy()
    common = np.zeros(len(left), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        inside = (left < n) & (right < n)
        same = inside.copy()
        same[inside] = ranks[level][left[inside]] == ranks[level][right[inside]]
        for array in (left, right, common):
            array[same] += step
    prefix = np.concatenate([[0], common]) if len(places) else np.zeros(0, np.int64)
    before = np.where(places == starts[number[places]], -1 - places, codes[places - 1])
    return places, prefix, before, number[places], starts


def maximal_repeats(prefix: np.ndarray, before: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of every maximal repeat of ``k`` or more bytes.

    The repeat's occurrences are the suffixes first..last of the sorted order. A stack of open
    common-prefix intervals is scanned once; an interval is a repeat if the bytes before its
    suffixes are not all the same, since it could be extended to the left otherwise.
    """
    mixed = -(1 << 62)  # stands for bytes that differ
    hits = np.flatnonzero(prefix >= k)
    if not len(hits):
        return
    for block in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
        first = int(block[0]) - 1
        heights = [*prefix[block].tolist(), 0]
        sides = before[first : first + len(heights)].tolist()
        stack: list[list[int]] = []  # height, first suffix, the byte before or mixed
        for i, height in enumerate(heights):
            # Suffix first + i belongs to the interval open at the height it shares with the next.
            start, side = first + i, sides[i]
            while stack and stack[-1][0] > height:
                top = stack.pop()
                if top[2] != side:
                    top[2] = side = mixed
                if top[2] == mixed:
                    yield top[0], top[1], first + i
                start, side = top[1], top[2]
            if stack and stack[-1][0] == height:
                if stack[-1][2] != side:
                    stack[-1][2] = mixed
            elif height:
                stack.append([height, start, side])


def repeat_groups(strings: list[bytes], k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Every maximal repeat: its length and all its occurrences as (string, offset)."""
    places, prefix, before, number, starts = suffix_array(strings, k)
    for length, first, last in maximal_repeats(prefix, before, k):
        chosen = slice(first, last + 1)
        offsets = places[chosen] - starts[number[chosen]]
        yield length, list(zip(number[chosen].tolist(), offsets.tolist(), strict=True))


def repeated_starts(strings: list[bytes], k: int) -> list[np.ndarray]:
    """Per string, whether the ``k`` bytes from each place also start somewhere else."""
    places, prefix, before, number, starts = suffix_array(strings, k)
    reach = np.zeros(len(places), np.int64)
    for length, first, last in maximal_repeats(prefix, before, k):
        chosen = slice(first, last + 1)
        reach[chosen] = np.maximum(reach[chosen], length)
    total = sum(map(len, strings)) + len(strings)
    found = np.flatnonzero(reach)
    marked = spans_of(places[found], reach[found] - k + 1, 1, total)
    return [marked[s : s + max(0, len(x) - k + 1)] for s, x in zip(starts, strings, strict=True)]


def repeated_bytes(docs: DataFrame, k: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(row, start, n): n windows from byte ``start`` that also start anywhere else.

    ``docs`` is that of :func:`keyed`.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[tuple[int, int]] = []
        strings: list[bytes] = []
        size, last = 0, None
        for batch in batches:
            for mini, key, packed in zip(batch["mini"], batch["key"], batch["packed"], strict=True):
                if keys and keys[-1] == (mini, key):
                    continue  # a row that repeats
                # Buckets share no window, so several can share a suffix array.
                if mini != last and size > _BATCH:
                    yield marks(keys, strings)
                    keys, strings, size = [], [], 0
                keys.append((mini, key))
                strings.append(packed)
                size, last = size + len(packed), mini
        if strings:
            yield marks(keys, strings)

    def marks(keys: list[tuple[int, int]], strings: list[bytes]) -> pd.DataFrame:
        out = []
        for key, marked in zip(keys, repeated_starts(strings, k), strict=True):
            edge = np.diff(np.concatenate([[0], marked.view(np.int8), [0]]))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            out += [(*key, s, e - s) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["mini", "key", "offset", "n"])

    windows = Windows(k, min(M_BYTES, 1 << (k.bit_length() - 1)), False)
    occurrences = repeated_runs(docs, windows)
    distinct = distinct_runs(occurrences)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    # A run that occurs twice repeats with all its windows.
    copied = distinct.filter("copied").select("mini", "key", zero.alias("offset"), "n")
    buckets = mixed_buckets(distinct, k)
    met = distinct.join(buckets, "mini")
    small, large = F.col("units") <= bucket_bytes, F.col("units") > bucket_bytes
    scanned = (
        packed_runs(docs, met.filter(small), windows)
        .select("mini", "key", "packed")
        .repartition("mini")
        .sortWithinPartitions("mini", "key")
        .mapInPandas(scan, "mini long, key long, offset long, n long")
    )
    pieces = (
        packed_runs(docs, met.filter(large), windows)
        .dropDuplicates(["mini", "key"])
        .select(
            "mini", "key", "packed", F.explode(F.sequence(zero, F.length("packed") - k)).alias("offset")
        )
        .select(
            "mini", "key", "offset", F.expr(f"substring(packed, int(offset) + 1, {k})").alias("window")
        )
    )
    # Windows of one string differ, or they would lie in different runs.
    twice = pieces.groupBy("window").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    single = pieces.join(twice, "window", "left_semi").select(
        "mini", "key", "offset", one.alias("n")
    )
    found = copied.unionAll(scanned).unionAll(single)
    return (
        occurrences.select("mini", "key", "row", "start")
        .join(found, ["mini", "key"])
        .select("row", (F.col("start") + F.col("offset")).alias("start"), "n")
    )


def remove_repeated_bytes(docs: DataFrame, k: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without their repeated substrings.

    ``kept`` is binary, since spans may begin or end inside a character. Strings are judged on
    the input and never cross documents. Null and empty texts have no bytes, texts under ``k``
    bytes no string. Rows with the same doc_id and text count as one document and get one
    result each; rows with the same doc_id and different texts are different documents. Other
    columns are ignored.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, starts, counts in zip(
                *(batch[c] for c in ("doc_id", "text", "starts", "counts")), strict=True
            ):
                data = text.encode()
                gone = spans = 0
                kept = data
                if starts is not None:
                    covered = spans_of(np.array(starts), np.array(counts), k, len(data))
                    gone = int(covered.sum())
                    spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                out.append((doc_id, len(data), gone, spans, kept))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    docs = keyed(docs)
    return (
        with_windows(docs, repeated_bytes(docs, k))
        .select("doc_id", "text", "starts", "counts")
        .mapInPandas(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def op8_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that also start elsewhere."""
    left = remove_repeated_bytes(table(spark, sf_dir, "documents"), 200)
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
