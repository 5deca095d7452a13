"""Ranked search: best-first over intervals of documents, bounded by range-maximum queries.

Documents are read once for the terms of the queries. Each shard of them keeps a posting list
per term, ordered by document, and sparse tables that tell the place of the largest impact in
any range of a list. The sum of these maxima over a query's terms bounds the score of every
document in an interval, and is the score of an interval of one document. Intervals are taken
by their bound, the highest first, and split at the document with the largest impact, until
no bound reaches the scores already found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmargin.llm.common import stored, table

# Everything in ASCII that is no letter or digit parts terms, A-Z become a-z.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

QUERY_BYTES = 4_000_000  # text of the queries that are searched together, on average at most
SHARD_POSTINGS = 2_000_000  # postings of a shard, or those of one document
_LEAF = 24  # documents of an interval that is split into all of them
_AT_ONCE = 48  # intervals taken together


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERMS).split()


def _postings(batches: Iterator[pd.DataFrame], number: dict[bytes, int]) -> Iterator[pd.DataFrame]:
    """Terms of the queries in each document (doc_id, n, terms, counts), by their numbers."""
    wanted = number.keys()
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found = Counter(terms_of(text))
            held = wanted & found.keys()
            rows.append((found.total(), [number[t] for t in held], [found[t] for t in held]))
        out = pd.DataFrame(rows, columns=["n", "terms", "counts"])
        out.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
        yield out[out["n"] > 0]


@dataclass(frozen=True)
class Shard:
    """Posting lists of some documents, one after the other, and their sparse tables.

    ``keys`` are list * (documents + 1) + document in ascending order, ``impacts`` the impacts
    there. ``tables[j][i]`` is the place of the largest of the 2**j impacts from place i on; a
    range within a list is covered by two such blocks that lie in it.
    """

    documents: int
    keys: np.ndarray
    impacts: np.ndarray
    tables: list[np.ndarray]

    @staticmethod
    def of(documents: int, lists: np.ndarray, places: np.ndarray, impacts: np.ndarray) -> Shard:
        keys = lists.astype(np.int64) * (documents + 1) + places
        order = np.argsort(keys)
        keys, impacts = keys[order], impacts[order]
        longest = int(np.bincount(lists).max(initial=0))
        tables, width = [np.arange(len(keys), dtype=np.int32)], 1
        while 2 * width <= longest:
            a, b = tables[-1][:-width], tables[-1][width:]
            tables.append(np.where(impacts[b] > impacts[a], b, a))
            width *= 2
        return Shard(documents, keys, impacts, tables)

    def largest(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the largest impact of each list (column) in low..high-1 (row), or -1."""
        base = lists * (self.documents + 1)
        first = np.searchsorted(self.keys, base[None, :] + low[:, None])
        count = np.searchsorted(self.keys, base[None, :] + high[:, None]) - first
        out = np.full(first.shape, -1, np.int64)
        level = np.frexp(np.maximum(count, 1))[1] - 1
        for j in np.unique(level[count > 0]).tolist():
            at = (level == j) & (count > 0)
            a = self.tables[j][first[at]]
            b = self.tables[j][first[at] + count[at] - (1 << j)]
            out[at] = np.where(self.impacts[b] > self.impacts[a], b, a)
        return out


def search_shard(shard: Shard, lists: np.ndarray, weights: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The ``most`` best documents (score, place) for some lists and their weights.

    All ties with the last of them are included.
    """

    def bounds(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = shard.largest(lists, low, high)
        values = np.where(place >= 0, shard.impacts[place] * weights[None, :], 0)
        top = values.argmax(axis=1)
        split = shard.keys[place[np.arange(len(low)), top]] % (shard.documents + 1)
        return values.sum(axis=1), split

    low, high = np.zeros(1, np.int64), np.full(1, shard.documents, np.int64)
    bound, split = bounds(low, high)
    scores, places = np.empty(0, np.int64), np.empty(0, np.int64)
    least = 1  # scores must be above zero
    while True:
        open_ = bound >= least
        low, high, bound, split = low[open_], high[open_], bound[open_], split[open_]
        if not len(bound):
            break
        now = np.argpartition(-bound, min(_AT_ONCE, len(bound)) - 1)[:_AT_ONCE]
        a, b, s = low[now], high[now], split[now]
        low, high, bound, split = (np.delete(x, now) for x in (low, high, bound, split))
        small = b - a <= _LEAF
        sizes = (b - a)[small]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        single = np.concatenate([s[~small], np.repeat(a[small], sizes) + inside])
        left = np.concatenate([a[~small], s[~small] + 1])
        right = np.concatenate([s[~small], b[~small]])
        left, right = left[left < right], right[left < right]
        new, at = bounds(np.concatenate([single, left]), np.concatenate([single + 1, right]))
        done, new, at = new[: len(single)], new[len(single) :], at[len(single) :]
        good = done >= least
        scores, places = np.concatenate([scores, done[good]]), np.concatenate([places, single[good]])
        if len(scores) > most:
            least = max(least, int(np.partition(scores, len(scores) - most)[len(scores) - most]))
            best = scores >= least
            scores, places = scores[best], places[best]
        low, high = np.concatenate([low, left]), np.concatenate([high, right])
        bound, split = np.concatenate([bound, new]), np.concatenate([split, at])
    return list(zip(scores.tolist(), places.tolist(), strict=True))


@dataclass(frozen=True)
class Queries:
    """Queries of one block: their terms by number, in one flat array, and the terms' weights."""

    numbers: np.ndarray
    starts: np.ndarray
    weights: np.ndarray


def _search(batches: Iterator[pd.DataFrame], queries: Queries, documents: int, terms: int, most: int) -> Iterator[pd.DataFrame]:
    """The best documents (query, doc_id, score) of every shard that the batches make up."""

    def shards() -> Iterator[pd.DataFrame]:
        held, size, current = [], 0, 0
        for batch in batches:
            after = size + np.cumsum(batch["terms"].str.len().to_numpy(np.int64))
            for shard, part in batch.groupby(after // SHARD_POSTINGS):
                if shard != current and held:
                    yield pd.concat(held, ignore_index=True)
                    held = []
                current = shard
                held.append(part)
            size = int(after[-1]) if len(after) else size
        if held:
            yield pd.concat(held, ignore_index=True)

    for rows in shards():
        n = rows["n"].to_numpy(np.int64)
        lengths = rows["terms"].str.len().to_numpy(np.int64)
        numbers = np.concatenate([np.asarray(x, np.int64) for x in rows["terms"]])
        counts = np.concatenate([np.asarray(x, np.int64) for x in rows["counts"]])
        # Documents of one language share their frequent words: they stand together, by length.
        first = np.cumsum(lengths) - lengths
        common = np.array([numbers[f + counts[f : f + c].argmax()] for f, c in zip(first, lengths, strict=True)])
        order = np.lexsort((n, common))
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        owner = np.repeat(np.arange(len(rows)), lengths)
        m = 10 + 90 * n * documents // terms
        impacts = 1_000_000_000 * counts // (1000 * counts + 8 * m[owner])
        shard = Shard.of(len(rows), numbers, place[owner], impacts)
        ids = rows["doc_id"].astype("Int64").to_numpy(object)[order]
        found = []
        for q, (a, b) in enumerate(zip(queries.starts[:-1], queries.starts[1:], strict=True)):
            mine = queries.numbers[a:b]
            if len(mine):
                best = [(score, ids[at]) for score, at in search_shard(shard, mine, queries.weights[mine], most)]
                best.sort(key=lambda x: (-x[0], x[1] is pd.NA, 0 if x[1] is pd.NA else x[1]))
                found += [(q, doc_id, score) for score, doc_id in best[:most]]
        out = pd.DataFrame(found, columns=["query", "doc_id", "score"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def weight_of(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def ranked_search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best rows of ``docs`` for every item.

    Scores are sums of integer impacts, ties go to the smaller doc_id (null last). Rows of
    ``docs`` that repeat are documents of their own; items that repeat as a whole count once,
    and one item_id with several texts has results for each. Null and empty texts have no terms.
    Items are searched in blocks of some `QUERY_BYTES` of text, each over all documents.
    """
    texts = items.select(F.col("item_id").cast("long"), "text").filter("text <> ''").distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // QUERY_BYTES))
    placed = texts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    results = [_search_block(docs, placed.filter(F.col("block") == b), most) for b in range(blocks)]
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out


def _search_block(docs: DataFrame, items: DataFrame, most: int) -> DataFrame:
    """The results of one block of items, whose texts are small enough for the driver."""
    spark = docs.sparkSession
    rows = sorted(items.select("item_id", "text").collect(), key=lambda r: (r.item_id is None, r.item_id, r.text))
    of_item = [sorted(set(terms_of(r.text))) for r in rows]
    names = sorted({t for terms in of_item for t in terms})
    number = {t: i for i, t in enumerate(names)}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _postings(batches, number)

    held = stored(
        docs.select(F.col("doc_id").cast("long"), "text")
        .filter("text <> ''")
        .mapInPandas(read, "doc_id long, n long, terms array<int>, counts array<int>"),
        "postings",
    )
    documents, terms = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([weight_of(documents, holding.get(i, 0)) for i in range(len(names))], np.int64)
    queries = Queries(
        np.array([number[t] for terms_ in of_item for t in terms_], np.int64),
        np.concatenate([[0], np.cumsum([len(t) for t in of_item])]).astype(np.int64),
        weights,
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _search(batches, queries, documents, terms, most)

    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ids = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(rows)], "query long, item_id long")
    return (
        held.filter(F.size("terms") > 0)
        .mapInPandas(search, "query long, doc_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= most)
        .join(F.broadcast(ids), "query")
        .select("item_id", "rank", "doc_id", "score")
    )


def op12_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=10)


OP12_SQL = r"""
with terms as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents where text is not null),
sized as (select doc_id, len(t)::bigint as n from terms where len(t) > 0),
total as (select count(*)::bigint as docs, sum(n)::bigint as words from sized),
counted as (select doc_id, t, count(*)::bigint as tf from (select doc_id, unnest(t) as t from terms) group by all),
held as (select t, count(*)::bigint as df from counted group by t),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
  from benchmark where text is not null),
weighed as (
  select item_id, asked.t, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from asked join held using (t), total),
scored as (
  select item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // words)))))::bigint as score
  from weighed join counted using (t) join sized using (doc_id), total group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
