"""Near duplicates by SimHash, found by meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart have a value between them within half the
radius of both. So every fingerprint emits all values of its half ball, the rows meet at
equal values, and whatever meets is linked. A bucket never holds more distinct fingerprints
than a half ball has values, however many documents share them.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridmargin.llm.common import checkpointed, connected_components, stored, table

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z
_hash = partial(xxhash.xxh64_intdigest, seed=42)
_SLICE = 1 << 16


def shingles_of(words: list[bytes], width: int) -> list[bytes]:
    """All runs of ``width`` words joined by a space; all words, if they are fewer."""
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, split at ASCII white space."""
    return text.encode().translate(LOWER).split() if text else []


def simhash(text: str | None, width: int) -> int:
    """64-bit majority fingerprint over the shingles, signed; zero without a word."""
    shingles = shingles_of(words_of(text), width)
    hashes = np.fromiter(map(_hash, shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(
            hashes[i : i + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int) -> Column:
    """The fingerprint of a text column as a signed long; null counts as no words."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, width) for t in texts], dtype="int64")

    return of(text)


def half_ball(value: Column, half: int, bits: int = 64) -> Column:
    """Array of all values at most ``half`` bits from ``value``."""
    masks = [
        F.array(*[F.lit(_signed(sum(1 << b for b in chosen))) for chosen in combinations(range(bits), n)])
        for n in range(half + 1)
    ]
    return F.transform(reduce(lambda a, b: F.concat(a, b), masks), lambda mask: value.bitwiseXOR(mask))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked_fingerprints(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within ``radius`` bits.

    The members of one bucket are all within the radius of each other, so linking each to the
    smallest loses no connection and writes one row per member instead of all pairs.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    bucket = Window.partitionBy("variant")
    return (
        fingerprints.select("fp", F.explode(half_ball(F.col("fp"), radius // 2)).alias("variant"))
        .select("fp", F.min("fp").over(bucket).alias("least"))
        .filter("fp <> least")
        .distinct()
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= radius)
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
    )


def _components(prints: DataFrame, radius: int, first: Column) -> DataFrame:
    """(fp, first): of every fingerprint the least ``first`` among the rows reachable."""
    classes = prints.groupBy("fp").agg(F.min(first).alias("least"))
    roots = connected_components(linked_fingerprints(classes.select("fp"), radius))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.join(names, "root").select("fp", "first")


def simhash_groups(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` bits.
    Null and empty texts have the fingerprint zero and are linked like any other; equal texts
    and repeated rows share a fingerprint; a null doc_id joins a group but never names it
    unless it has no other id. Other columns of ``docs`` are ignored.
    """
    prints = checkpointed(docs.select("doc_id", fingerprint(F.col("text"), width).alias("fp")))
    named = _components(prints, radius, F.col("doc_id")).withColumnRenamed("first", "component_id")
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """Rows of ``docs``, all columns, of which one of each group of `simhash_groups` stays.

    It is the one with the smallest doc_id (null last); of several texts under that id the one
    with the smaller hash, of rows that repeat one. Null and empty texts are one group.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    prints = stored(
        docs.select(
            F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").cast("long"), key.alias("row")).alias("at"),
            fingerprint(F.col("text"), width).alias("fp"),
        ),
        "fingerprints",
    )
    kept = stored(_components(prints, radius, F.col("at")), "kept-copies")
    rows = prints.join(kept, "fp", "left").select("at.row", (F.col("at") == F.col("first")).alias("kept"))
    # The rows that go, and those that occur more than once, are fewer than those that stay.
    counted = rows.groupBy("row").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    special = stored(counted.filter("not kept or n > 1").select("row", "kept"), "near-copies")
    numbered = docs.select(key.alias("row"), F.struct(*docs.columns).alias("doc"))
    once = numbered.join(special, "row", "left_anti")
    repeated = numbered.join(special.filter("kept"), "row", "left_semi").dropDuplicates(["row"])
    return once.unionAll(repeated).select("doc.*")


def op3_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; three-word shingles, two bits."""
    groups = simhash_groups(table(spark, sf_dir, "documents"), width=3, radius=2)
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
