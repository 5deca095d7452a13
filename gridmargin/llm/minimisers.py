"""Where texts may repeat: windows grouped by their minimiser.

A window is ``k`` consecutive units (words or bytes) of one document. Its minimiser is the
m-gram in it with the smallest hash, the leftmost of equals, so windows of equal content have
equal minimisers. Consecutive windows that share one are a run, which overlaps its neighbours
by k - 1 units only. A run whose minimiser occurs nowhere else holds no repeated window: two
equal windows would have their minimiser at the same place in them, hence in two runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmargin.llm.common import stored

_CHUNK = 1 << 19  # units handled at once; a place in a chunk fits into _PLACE bits
_PLACE = 20
_MASK = np.uint64((1 << _PLACE) - 1)
_TABLE = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)
_FACTORS = np.random.default_rng(43).integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Windows:
    """k units in a window, m (a power of two) in its m-grams; units are words or bytes."""

    k: int
    m: int
    words: bool

    def units(self, data: bytes) -> int:
        return len(data.split()) if self.words else len(data)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def unit_hashes(data: bytes, windows: Windows) -> np.ndarray:
    """One 64-bit hash per unit of a document."""
    codes = np.frombuffer(data, np.uint8)
    if not windows.words:
        return _TABLE[codes]
    starts, ends = word_bounds(codes)
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), _CHUNK):
        first, last = starts[a : a + _CHUNK], ends[a : a + _CHUNK]
        lengths = last - first
        total = int(lengths.sum())
        at = np.cumsum(lengths) - lengths
        inside = np.arange(total) - np.repeat(at, lengths)
        weights = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, _FACTORS[7], np.uint64))
        values = _TABLE[codes[np.repeat(first, lengths) + inside]] * weights[inside]
        out[a : a + _CHUNK] = mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))
    return out


def _slide_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, for digests of parts of a chunk."""
    inverse = np.uint64(pow(int(_FACTORS[6]), -1, 1 << 64))
    return tuple(
        np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * _CHUNK, f, np.uint64)]))
        for f in (_FACTORS[6], inverse)
    )


def _digests(units: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit digest of the units first..last-1 of each run."""
    up, down = _powers()
    sums = np.concatenate([[np.uint64(0)], np.cumsum(units * up[: len(units)])])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def _runs(units: np.ndarray, ends: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """Minimiser hash, digest, start and number of windows of every run in joined documents.

    ``ends`` has the end of the document for every unit.
    """
    n = len(units) - windows.k + 1
    if n <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    grams, size = units, 1
    while size < windows.m:
        grams = grams[:-size] * _FACTORS[size.bit_length() - 1] + grams[size:]
        size *= 2
    grams = mix(grams)
    keys = (grams & ~_MASK) | np.arange(len(grams), dtype=np.uint64)
    place = (_slide_min(keys, windows.k - windows.m + 1) & _MASK).astype(np.int64)
    valid = np.arange(n) + windows.k <= ends[:n]
    place[~valid] = -1
    new = np.concatenate([[True], place[1:] != place[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [n]]))
    used = place[first] >= 0
    first, count = first[used], count[used]
    return grams[place[first]], _digests(units, first, first + count + windows.k - 1), first, count


def document_runs(
    docs: list[bytes], windows: Windows
) -> Iterator[tuple[np.ndarray, ...]]:
    """(document number, minimiser, digest, start unit, windows) of all runs, by chunks.

    Long documents are handled in chunks that overlap by k - 1 units.
    """
    pieces: list[tuple[int, int, np.ndarray]] = []
    held = 0
    for number, data in enumerate(docs):
        if len(data) < windows.k:
            continue
        units = unit_hashes(data, windows)
        for start in range(0, len(units) - windows.k + 1, _CHUNK):
            piece = units[start : start + _CHUNK + windows.k - 1]
            if held + len(piece) > 2 * _CHUNK - windows.k and pieces:
                yield _joined(pieces, windows)
                pieces, held = [], 0
            pieces.append((number, start, piece))
            held += len(piece)
    if pieces:
        yield _joined(pieces, windows)


def _joined(pieces: list[tuple[int, int, np.ndarray]], windows: Windows) -> tuple[np.ndarray, ...]:
    lengths = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(lengths)
    grams, digests, first, count = _runs(
        np.concatenate([p[2] for p in pieces]), np.repeat(ends, lengths), windows
    )
    at = np.searchsorted(ends, first, "right")
    numbers, starts = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    return (
        numbers[at],
        grams.view(np.int64),
        digests.view(np.int64),
        first - (ends - lengths)[at] + starts[at],
        count,
    )


def row_key() -> Column:
    """Identity of a document: rows equal in doc_id and text are one document."""
    return F.xxhash64("doc_id", "text")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row) of all documents; null texts are empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).select(
        "doc_id", "text", row_key().alias("row")
    )


def repeated_runs(docs: DataFrame, windows: Windows) -> DataFrame:
    """(mini, key, doc_id, row, start, n): runs whose minimiser occurs more than once.

    First only minimisers travel, to be counted with partial sums; then the runs of repeated
    ones, without their text. ``mini`` and ``key``, two independent 64-bit hashes of a run's
    units, stand for its content. ``docs`` is that of :func:`keyed`.
    """

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, ids = batch["row"].to_numpy(), batch["doc_id"].astype("Int64")
            for number, mini, key, start, count in document_runs(
                [t.encode() for t in batch["text"]], windows
            ):
                yield pd.DataFrame(
                    {
                        "mini": mini,
                        "key": key,
                        "doc_id": ids.iloc[number].to_numpy(),
                        "row": rows[number],
                        "place": start * 256 + count,
                    }
                ).astype({"doc_id": "Int64"})

    if windows.k - windows.m + 1 > 255:
        raise ValueError("a run must have fewer than 256 windows")
    runs = docs.mapInPandas(
        places, "mini long, key long, doc_id long, row long, place long"
    )
    repeated = runs.groupBy("mini").agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1")
    return stored(
        runs.join(repeated, "mini", "left_semi").select(
            "mini",
            "key",
            "doc_id",
            "row",
            F.shiftright("place", 8).alias("start"),
            F.col("place").bitwiseAND(F.lit(255).cast("long")).alias("n"),
        ),
        "runs",
    )


def distinct_runs(occurrences: DataFrame) -> DataFrame:
    """(mini, key, first, copied, n): runs of one content, the first of them, and if it recurs.

    ``first`` holds doc_id, row and start; the smallest comes first.
    """
    at = F.struct("doc_id", "row", "start")
    return stored(
        occurrences.groupBy("mini", "key").agg(
            F.min(at).alias("first"),
            (F.min(at) != F.max(at)).alias("copied"),
            F.min("n").alias("n"),
        ),
        "distinct-runs",
    )


def mixed_buckets(distinct: DataFrame, k: int) -> DataFrame:
    """(mini, units): minimisers at which different runs meet, and how long these are together."""
    return (
        distinct.groupBy("mini")
        .agg(F.count(F.lit(1)).alias("strings"), F.sum(F.col("n") + (k - 1)).alias("units"))
        .filter("strings > 1")
        .select("mini", "units")
    )


def packed_runs(docs: DataFrame, runs: DataFrame, windows: Windows) -> DataFrame:
    """(mini, key, doc_id, row, start, packed) of ``runs`` (mini, key, first, n).

    The first occurrence of each run is cut out of its document as one packed string.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, size = [], 0
            columns = (batch[c] for c in ("doc_id", "row", "text", "found"))
            for doc_id, row, text, found in zip(*columns, strict=True):
                data = text.encode()
                words = data.split() if windows.words else None
                for run in found:
                    mini, key, start, count = (int(run[c]) for c in ("mini", "key", "start", "n"))
                    stop = start + count + windows.k - 1
                    packed = b" ".join(words[start:stop]) if windows.words else data[start:stop]
                    out.append((mini, key, doc_id, row, start, packed))
                    size += len(packed)
                if size > 1 << 23:
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    names = ["mini", "key", "doc_id", "row", "start", "packed"]
    wanted = (
        runs.select("first.row", F.struct("mini", "key", "first.start", "n").alias("run"))
        .groupBy("row")
        .agg(F.collect_list("run").alias("found"))  # at most one per unit of a document
    )
    # With the same columns as the last join of the callers, so that Spark shuffles them once.
    return (
        docs.join(wanted, "row")
        .select("doc_id", "text", "row", "found")
        .mapInPandas(
            cut, "mini long, key long, doc_id long, row long, start long, packed binary"
        )
    )
