"""Near duplicates by HyperMinHash: banded compressed registers, then exact set similarity.

The shingles of a document are thrown into ``buckets``; a register keeps of its smallest value
the number of leading zeros and ten bits of mantissa. Documents meet where all registers of a
band are equal. The share of equal registers, less the collisions that the compression makes,
estimates the similarity; pairs that may reach it are verified on their full sets.

Sets have sizes of some class, powers of four; those of a class throw every shingle so often
that no register stays empty, and sets near the lower end of a class take part in the one
below, so that any two similar sets have a class in common. Two sets at the least similarity
share no band with a chance of 6e-8 (`Bands`). A band value that very many sets share says
little about them; those sets meet at longer bands instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmargin.llm.common import checkpointed, connected_components, stored, table
from gridmargin.llm.minimisers import mix, unit_hashes, Windows
from gridmargin.llm.simhash import LOWER

MANTISSA = 10
EMPTY = 65_535  # no register of 57 counts of zeros and ten bits reaches it
_THROWN = 8  # shingles for each bucket, at least
_CROWD = 16  # sets that may share a band value before longer bands take over
_FEW = 4  # sets that may have a shingle before it is no longer rare
_GROWTH = 4  # by so much more partners are asked in each round
_WORDS_OF_BITS = 1 << 21
_SLICE = 500
_WORDS = Windows(1, 1, True)


@dataclass(frozen=True)
class Bands:
    """``bands`` of ``rows`` registers; two sets of similarity s share none with chance
    (1 - s ** rows) ** bands: 6e-8 and 1e-8 at 0.8 for the two below."""

    rows: int
    bands: int

    @property
    def buckets(self) -> int:
        return self.rows * self.bands


SHORT, LONG = Bands(5, 42), Bands(10, 160)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``width`` lower-cased words, or of all words."""
    words = unit_hashes(text.encode().translate(LOWER), _WORDS) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = mix(total + words[i : i + len(total)] + np.uint64(width))
    return np.unique(total)


def set_id(shingles: np.ndarray) -> int:
    """64 bits that stand for a set, signed; two of n sets share them with chance n**2 / 2**65."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def classes_of(size: int, least: float) -> list[int]:
    """The classes of sizes that a set takes part in, the highest first."""
    own = (size.bit_length() - 1) // 2
    return [own, own - 1] if own and size * least < 4**own else [own]


def registers(shingles: np.ndarray, size_class: int, buckets: int) -> np.ndarray:
    """The compressed registers of a set: 1,024 * leading zeros + mantissa."""
    times = max(1, -(-_THROWN * buckets // 4**size_class))
    seeds = mix(np.arange(1, times + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    thrown = np.sort(mix(shingles[None, :] ^ seeds[:, None]).ravel())
    edges = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    first = np.searchsorted(thrown, edges)
    filled = np.diff(np.append(first, len(thrown))) > 0
    value = (thrown[np.minimum(first, len(thrown) - 1)] - edges)[filled].astype(np.float64)
    part, exponent = np.frexp(value)
    zeros = ((1 << 64) // buckets).bit_length() - exponent
    out = np.full(buckets, EMPTY, np.uint16)
    mantissa = np.maximum((part * (2 << MANTISSA)).astype(np.int64) - (1 << MANTISSA), 0)
    out[filled] = (np.maximum(zeros, 0) << MANTISSA) + mantissa
    return out


def band_keys(found: np.ndarray, size_class: int, bands: Bands) -> np.ndarray:
    """A 64-bit value for each band of the registers of a class."""
    keys = np.arange(bands.bands, dtype=np.uint64) * np.uint64(64) + np.uint64(size_class)
    for column in found.reshape(bands.bands, bands.rows).T.astype(np.uint64):
        keys = mix(keys + column + np.uint64(1))
    return keys


def chance_equal(n: np.ndarray, m: np.ndarray, buckets: int) -> np.ndarray:
    """The chance that registers of unlike sets of n and m thrown values are equal.

    Both must have the same number of leading zeros and then the same mantissa.
    """
    share = 2.0 ** -np.arange(58)[None, :] / buckets
    at_least = [np.exp(x[:, None] * np.log1p(-share)) for x in (n, m)]  # no value below the bound
    same_zeros = [a[:, 1:] - a[:, :-1] for a in at_least]
    return (same_zeros[0] * same_zeros[1]).sum(axis=1) / (1 << MANTISSA)


def estimated(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarities of pairs of sets (rows of registers) of n and m thrown values."""
    buckets = a.shape[1]
    used = np.maximum(((a != EMPTY) | (b != EMPTY)).sum(axis=1), 1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1) / used
    by_chance = chance_equal(n, m, buckets)
    return (equal - by_chance) / (1 - by_chance)


def _sketched(batches: Iterator[pd.DataFrame], width: int, least: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), _SLICE):
            part = batch.iloc[at : at + _SLICE]
            sizes, ids, sketches = [], [], []
            for text in part["text"]:
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                ids.append(set_id(shingles) if len(shingles) else 0)
                kinds = classes_of(len(shingles), least) if len(shingles) else []
                sketches.append([registers(shingles, k, SHORT.buckets).tobytes() for k in kinds])
            yield pd.DataFrame(
                {"doc_id": part["doc_id"].astype("Int64"), "row": part["row"], "size": sizes, "set_id": ids, "sketches": sketches}
            )


def _short_keys(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """(key, set_id) for every band of every stored sketch."""
    for batch in batches:
        for at in range(0, len(batch), _SLICE):
            part = batch.iloc[at : at + _SLICE]
            keys, ids = [], []
            for own, size, sketches in zip(part["set_id"], part["size"], part["sketches"], strict=True):
                for kind, sketch in zip(classes_of(size, least), sketches, strict=True):
                    keys.append(band_keys(np.frombuffer(sketch, np.uint16), kind, SHORT))
                    ids.append(own)
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "set_id": np.repeat(ids, SHORT.bands)})


def _long_keys(batches: Iterator[pd.DataFrame], width: int, least: float) -> Iterator[pd.DataFrame]:
    """The same for the long bands, from the texts."""
    for batch in batches:
        for own, text in zip(batch["set_id"], batch["text"], strict=True):
            shingles = shingle_set(text, width)
            for kind in classes_of(len(shingles), least):
                keys = band_keys(registers(shingles, kind, LONG.buckets), kind, LONG)
                yield pd.DataFrame({"key": keys.view(np.int64), "set_id": np.full(LONG.bands, own)})


def _shared(bands: DataFrame, name: str) -> DataFrame:
    """(key, set_id, m): the distinct rows of ``bands`` whose key m > 1 sets share."""
    several = stored(
        bands.groupBy("key").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).filter("a <> b").select("key"),
        f"{name}-keys",
    )
    held = stored(bands.join(several, "key", "left_semi").distinct(), f"{name}-members")
    counts = stored(held.groupBy("key").agg(F.count(F.lit(1)).alias("m")), f"{name}-counts")
    return stored(held.join(counts, "key"), f"{name}-bands")


def _probably_in(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` whose ``row`` ``members`` have, and some more: few travel to the join that follows.

    Bits of hashes are broadcast, 16 for a member and 16 MB at most. An inner join must follow,
    as Spark would do a semi join first.
    """
    words = min(_WORDS_OF_BITS, 64 + members.count() // 4)
    place = F.xxhash64("row", F.lit(1))
    word, bit = F.pmod(place, F.lit(words)), F.pmod(F.floor(place / words), F.lit(64))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
    bits = members.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))
    return (
        rows.withColumn("word", word)
        .join(F.broadcast(bits), "word")
        .filter(F.col("bits").bitwiseAND(mask) != 0)
        .drop("word", "bits")
    )


def _hubs(bands: DataFrame) -> DataFrame:
    """(key, other): of each key the set that shares most band values with others.

    An original shares more of them with its copies than those do with each other.
    """
    met = stored(bands.groupBy("set_id").agg(F.least(F.sum("m"), F.lit((1 << 23) - 1)).alias("met")), "met")
    order = F.shiftleft("met", 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64("set_id"), 24))
    ranked = stored(bands.join(met, "set_id").select("key", "set_id", order.alias("order")), "ranked-bands")
    most = stored(ranked.groupBy("key").agg(F.max("order").alias("order")), "hubs")
    return ranked.join(most, ["key", "order"]).select("key", F.col("set_id").alias("other"))


def _likely(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """The pairs whose estimate is not six standard deviations below ``least``."""
    slack = 6 * (least * (1 - least) / SHORT.buckets) ** 0.5
    for batch in batches:
        rows = batch[batch["n"].clip(upper=batch["m"]) >= least * batch["n"].clip(lower=batch["m"])]
        if not len(rows):
            continue
        kinds = [(classes_of(n, least), classes_of(m, least)) for n, m in zip(rows["n"], rows["m"], strict=True)]
        common = [max(set(x) & set(y)) for x, y in kinds]
        a, b = (
            np.stack([np.frombuffer(s[k.index(c)], np.uint16) for s, k, c in zip(rows[col], own, common, strict=True)])
            for col, own in (("x", [k[0] for k in kinds]), ("y", [k[1] for k in kinds]))
        )
        times = np.maximum(1, -(-_THROWN * SHORT.buckets // 4 ** np.array(common)))
        may = estimated(a, b, rows["n"].to_numpy() * times, rows["m"].to_numpy() * times) >= least - slack
        yield rows.loc[may, ["a", "b"]]


def _verified(batches: Iterator[pd.DataFrame], width: int, percent: int) -> Iterator[pd.DataFrame]:
    """The pairs of texts whose sets have ``percent`` of their union in common."""
    for batch in batches:
        keep, last, held = [], None, None
        for x, y in zip(batch["x"], batch["y"], strict=True):
            if y is not last:
                last, held = y, shingle_set(y, width)
            other = shingle_set(x, width)
            both = len(np.intersect1d(other, held, assume_unique=True))
            keep.append(100 * both >= percent * (len(other) + len(held) - both))
        yield batch.loc[keep, ["a", "b"]]


def _may_be_similar(common: Column, size: Column, other_size: Column, percent: int) -> Column:
    """Whether sets with ``common`` shingles in common, at most, may have ``percent`` of their union."""
    return (100 + percent) * common >= percent * (size + other_size)


def _rare_shingles(texts: DataFrame, width: int) -> DataFrame:
    """(shingle, set_id): the shingles that a few sets of ``texts`` have at most."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _SLICE):
                part = batch.iloc[at : at + _SLICE]
                sets = [shingle_set(text, width) for text in part["text"]]
                ids = np.repeat(part["set_id"].to_numpy(), [len(s) for s in sets])
                yield pd.DataFrame({"shingle": np.concatenate(sets).view(np.int64), "set_id": ids})

    held = stored(
        texts.select("set_id", "text").mapInPandas(spread, "shingle long, set_id long"), "open-shingles"
    )
    few = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter(F.col("holders") <= _FEW)
    return stored(held.join(few.select("shingle"), "shingle", "left_semi"), "rare-shingles")


def _in_question(members: DataFrame, sizes: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """What is still to be asked of ``members`` (key, set_id, m, root) of crowded values.

    The first result holds the members that may be similar to another of their value with
    which they share no rare shingle, with ``size`` and ``common``, the shingles that are not
    rare. Such a pair has no more in common. The second result holds the pairs (a, b) of
    members that share rare shingles and may be similar; what they may have in common is those
    and the ones that are not rare. Copies of one text that were changed in different places
    have many rare shingles, so few of those that are not similar are in question.
    """
    rare = _rare_shingles(texts, width)
    known = stored(
        sizes.join(rare.groupBy("set_id").agg(F.count(F.lit(1)).alias("rare")), "set_id", "left").select(
            "set_id", "size", (F.col("size") - F.coalesce("rare", F.lit(0))).alias("common")
        ),
        "open-sizes",
    )
    sized = stored(members.join(known, "set_id"), "sized-bands")
    smallest = sized.groupBy("key").agg(F.min("size").alias("smallest"))
    able = sized.join(smallest, "key").filter(
        _may_be_similar(F.col("common"), F.col("size"), F.col("smallest"), percent)
    )
    meeting = (
        rare.toDF("shingle", "a")
        .join(rare.toDF("shingle", "b"), "shingle")
        .filter("a < b")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"))
        .join(known.toDF("a", "size", "common"), "a")
        .join(known.toDF("b", "other_size", "other_common"), "b")
    )
    most = F.col("shared") + F.least("common", "other_common")
    pairs = meeting.filter(_may_be_similar(most, F.col("size"), F.col("other_size"), percent))
    roots = members.select("set_id", "root").distinct()
    pairs = (
        pairs.select("a", "b")
        .join(roots.toDF("a", "root"), "a")
        .join(roots.toDF("b", "other_root"), "b")
        .filter("root <> other_root")
    )
    return able.select("key", "set_id", "m", "root", "size", "common"), pairs.select("a", "b")


def _mixed(rooted: DataFrame) -> DataFrame:
    """The keys whose members have several roots."""
    return rooted.groupBy("key").agg(F.min("root").alias("c"), F.max("root").alias("d")).filter("c <> d").select("key")


def similar_links(bands: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all sets that share a band value and are similar.

    In the first round the members of every value are asked against its hub, in the next ones
    against some leaders, more each time, chosen by a hash of the set; a value is done once
    links connect its members or all of them have been leaders. So a group of copies is settled
    by few pairs. A pair stays unasked only if its ends are connected or, in a crowded value, if
    too few of their shingles are held by both (:func:`_in_question`).
    """
    least = percent / 100
    pairs_schema = "a long, b long"
    none = sketches.select(F.col("set_id").alias("a"), F.col("set_id").alias("b")).limit(0)
    links, asked, roots = none, none, none.toDF("node", "root")
    leaders, rooted, more = 1, bands.withColumn("root", F.col("set_id")), none
    place = F.pmod(F.xxhash64("set_id"), F.lit(1 << 20)) / (1 << 20)
    while True:
        if leaders == 1:
            leading = _hubs(bands).withColumn("other_root", F.col("other"))
            may = F.lit(True)
        else:
            leading = rooted.filter(place * F.col("m") < leaders).select(
                "key",
                F.col("set_id").alias("other"),
                F.col("root").alias("other_root"),
                F.col("size").alias("other_size"),
                F.col("common").alias("other_common"),
            )
            both = F.least("common", "other_common")
            may = _may_be_similar(both, F.col("size"), F.col("other_size"), percent)
        new = checkpointed(
            rooted.join(leading, "key")
            .filter((F.col("root") != F.col("other_root")) & may)
            .select(F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b"))
            .unionAll(more)
            .distinct()
            .join(asked, ["a", "b"], "left_anti")
        )
        side = sketches.select("set_id", "size", "sketches")
        likely = stored(
            new.join(side.toDF("b", "m", "y"), "b")
            .join(side.toDF("a", "n", "x"), "a")
            .mapInPandas(lambda rows: _likely(rows, least), pairs_schema),
            "likely-pairs",
        )
        found = checkpointed(
            likely.join(texts.toDF("b", "y"), "b")
            .join(texts.toDF("a", "x"), "a")
            .mapInPandas(lambda rows: _verified(rows, width, percent), pairs_schema)
        )
        asked = asked.unionAll(new)
        open_ = rooted.filter(F.col("m") > leaders).select("key", "set_id", "m")
        if not found.isEmpty():
            links = links.unionAll(found)
            roots = connected_components(links)
        rooted = stored(
            open_.join(roots, open_.set_id == roots.node, "left").select(
                "key", "set_id", "m", F.coalesce("root", "set_id").alias("root")
            ),
            "rooted-bands",
        )
        members = stored(rooted.join(_mixed(rooted), "key", "left_semi"), "mixed-bands")
        if members.isEmpty():
            return links
        # What the next rounds read shrinks with the sets that are still to be asked.
        left = stored(members.select("set_id").distinct(), "open-sets")
        sketches = stored(sketches.join(left, "set_id", "left_semi"), "open-sketches")
        texts = stored(texts.join(left, "set_id", "left_semi"), "open-texts")
        sizes = sketches.select("set_id", "size")
        crowded = members.filter(F.col("m") > _CROWD)
        crowd = stored(crowded.select("set_id").distinct(), "crowded-sets")
        able, more = _in_question(
            crowded, sizes.join(crowd, "set_id"), texts.join(crowd, "set_id", "left_semi"), width, percent
        )
        others = members.filter(F.col("m") <= _CROWD).join(sizes, "set_id")
        rooted = stored(
            able.unionByName(others.select("key", "set_id", "m", "root", "size", F.col("size").alias("common"))),
            "waiting-bands",
        )
        leaders *= _GROWTH


def near_duplicate_groups(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    Documents are linked where the intersection of their shingle sets has ``percent`` of the
    union, and ``component_id`` is the smallest doc_id reachable. Null texts and those without
    words have no shingles and are linked with nothing. Equal sets are compared once, so rows
    that repeat cost nothing more. A null doc_id joins a group and names it only if there is no
    other. Other columns are ignored.
    """
    least = percent / 100
    keyed = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    rows = stored(
        keyed.mapInPandas(
            lambda batches: _sketched(batches, width, least),
            "doc_id long, row long, size long, set_id long, sketches array<binary>",
        ),
        "sketches",
    )
    full = rows.filter("size > 0")
    sets = stored(full.groupBy("set_id").agg(F.min("doc_id").alias("least_id"), F.min("row").alias("row")), "sets")
    bands = _shared(
        full.select("set_id", "size", "sketches").mapInPandas(
            lambda batches: _short_keys(batches, least), "key long, set_id long"
        ),
        "short",
    )
    members = stored(bands.select("set_id").distinct().join(sets.select("set_id", "row"), "set_id"), "members")
    first = (
        _probably_in(full.select("set_id", "row", "size", "sketches"), members)
        .join(members, ["set_id", "row"])
        .dropDuplicates(["set_id"])
    )
    sketches = stored(first.select("set_id", "size", "sketches"), "member-sketches")
    texts = stored(
        _probably_in(keyed.select("row", "text"), members)
        .join(members, "row")
        .dropDuplicates(["set_id"])
        .select("set_id", "text"),
        "member-texts",
    )
    crowded = bands.filter(F.col("m") > _CROWD).select("set_id").distinct()
    longer = _shared(
        texts.join(crowded, "set_id", "left_semi").mapInPandas(
            lambda batches: _long_keys(batches, width, least), "key long, set_id long"
        ),
        "long",
    )
    every = bands.filter(F.col("m") <= _CROWD).unionAll(longer)
    roots = connected_components(similar_links(every, sketches, texts, width, percent))
    rooted = sets.join(roots, sets.set_id == roots.node, "left").select(
        "set_id", "least_id", F.coalesce("root", "set_id").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stored(rooted.join(names, "root").select("set_id", "component_id"), "named-sets")
    return (
        rows.select("doc_id", "size", "set_id")
        .join(named, "set_id", "left")
        .withColumn("component_id", F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents; four-word shingles, similarity 0.8."""
    return near_duplicate_groups(table(spark, sf_dir, "documents"), width=4, percent=80)


OP13_SQL = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) as s
  from worded where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared
  from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared >= 80 * (x.n + y.n - shared)),
sides as (select a, b from links union all select b, a from links),
reached as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, s.b from reached r join sides s on s.a = r.other)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id, min(other) = d.doc_id as kept
from reached d left join sizes using (doc_id) group by d.doc_id
"""
