"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Vectors enter the graph in growing batches: a greedy search proposes neighbours, pruning with
a relaxed distance keeps diverse ones, and back edges are added and pruned alike. A query runs
a beam search in every shard. Largest inner product is turned into smallest distance by one
extra component that gives all vectors of a shard the same length. A shard holds vectors of
one band of lengths, so that a few long vectors can't make all others look alike.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmargin.llm.common import stored, table

DEGREE, BUILD_BEAM, QUERY_BEAM, RELAX = 40, 80, 160, 1.2
# Shards: at least so many, and so many vectors in one at most, on average.
LEAST_SHARDS, SHARD_VECTORS = 8, 50_000
# The longest vector of a shard is so many doublings longer than the shortest, at most.
BAND = 2
BLOCK_QUERIES = 5_000
_BATCH = 256


def beam_search(
    queries: np.ndarray, vectors: np.ndarray, edges: np.ndarray, entry: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Beams of all queries at once: (numbers, inner products), best first, -1 where empty.

    Each step expands the best unexpanded vector of every beam, until there is none.
    """
    n = len(queries)
    beam = np.full((n, width), -1, np.int32)
    score = np.full((n, width), -np.inf, np.float32)
    open_score = score.copy()  # -inf where expanded
    seen = np.zeros((n, len(vectors)), bool)
    beam[:, 0] = entry
    score[:, 0] = open_score[:, 0] = queries @ vectors[entry]
    seen[:, entry] = True
    active = np.arange(n)
    while len(active):
        best = open_score[active].argmax(axis=1)
        more = open_score[active, best] > -np.inf
        active, best = active[more], best[more]
        if not len(active):
            break
        open_score[active, best] = -np.inf
        found = edges[beam[active, best]]
        fresh = found >= 0
        fresh &= ~seen[active[:, None], found]
        rows, columns = np.nonzero(fresh)
        seen[active[rows], found[rows, columns]] = True
        near = np.full(found.shape, -np.inf, np.float32)
        near[rows, columns] = np.einsum(
            "ij,ij->i", vectors[found[rows, columns]], queries[active[rows]]
        )
        numbers = np.concatenate([beam[active], found], axis=1)
        scores = np.concatenate([score[active], near], axis=1)
        opens = np.concatenate([open_score[active], near], axis=1)
        keep = np.argpartition(-scores, width - 1, axis=1)[:, :width]
        beam[active] = np.where(
            np.take_along_axis(scores, keep, 1) > -np.inf, np.take_along_axis(numbers, keep, 1), -1
        )
        score[active] = np.take_along_axis(scores, keep, 1)
        open_score[active] = np.take_along_axis(opens, keep, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(beam, order, 1), np.take_along_axis(score, order, 1)


def robust_prune(
    points: np.ndarray, candidates: np.ndarray, vectors: np.ndarray, degree: int, relax: float
) -> np.ndarray:
    """Up to ``degree`` diverse neighbours for each of ``points`` out of its ``candidates``.

    ``candidates`` holds distinct numbers per row, padded with -1. The nearest is taken again
    and again, and those go that are closer to it, by the factor ``relax``, than to the point.
    """
    valid = (candidates >= 0) & (candidates != points[:, None])
    # In doubles, as the distance of near vectors is the small difference of large numbers.
    found = vectors[np.maximum(candidates, 0)].astype(np.float64)
    centre = vectors[points].astype(np.float64)
    square = np.einsum("bcd,bcd->bc", found, found)
    to_point = square + np.einsum("bd,bd->b", centre, centre)[:, None]
    to_point = np.maximum(to_point - 2 * np.einsum("bcd,bd->bc", found, centre), 0)
    between = square[:, :, None] + square[:, None, :] - 2 * (found @ found.transpose(0, 2, 1))
    rows = np.arange(len(points))
    alive = np.where(valid, to_point, np.inf)
    out = np.full((len(points), degree), -1, np.int32)
    for i in range(degree):
        best = alive.argmin(axis=1)
        ok = alive[rows, best] < np.inf
        if not ok.any():
            break
        out[ok, i] = candidates[rows[ok], best[ok]]
        alive[relax * between[rows, best] <= to_point] = np.inf
        alive[rows, best] = np.inf
    return out


def same_length(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest one's length, with one more component that makes all lengths 1."""
    scaled = vectors / max(np.abs(vectors).max(initial=0), np.finfo(float).tiny)
    squares = (scaled**2).sum(axis=1)
    longest = max(squares.max(initial=0), np.finfo(float).tiny)
    extra = np.sqrt(np.maximum(1 - squares / longest, 0))
    return np.concatenate([scaled / np.sqrt(longest), extra[:, None]], axis=1).astype(np.float32)


def build_graph(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """(edges, entry) of a graph over vectors of the same length; edges are padded with -1."""
    n = len(vectors)
    edges = np.full((n, DEGREE), -1, np.int32)
    if n == 0:
        return edges, 0
    mean = vectors.mean(axis=0)
    entry = int((vectors @ mean).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done : done + min(_BATCH, done)]
        near, _ = beam_search(vectors[batch], vectors, edges, entry, BUILD_BEAM)
        # The batch members don't find each other in the graph yet, so they are proposed too.
        peers = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(peers, -np.inf)
        some = min(16, len(batch) - 1)
        if some:
            chosen = np.argpartition(-peers, some - 1, axis=1)[:, :some]
            near = np.concatenate([near, batch[chosen].astype(np.int32)], axis=1)
        edges[batch] = robust_prune(batch, near, vectors, DEGREE, RELAX)
        _add_back_edges(batch, edges, vectors)
        done += len(batch)
    return edges, entry


def _add_back_edges(batch: np.ndarray, edges: np.ndarray, vectors: np.ndarray) -> None:
    new = edges[batch]
    rows, columns = np.nonzero(new >= 0)
    targets, sources = new[rows, columns], batch[rows].astype(np.int32)
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    points, first, count = np.unique(targets, return_index=True, return_counts=True)
    for at in range(0, len(points), 128):
        some, wide = points[at : at + 128], count[at : at + 128]
        added = np.full((len(some), int(wide.max())), -1, np.int32)
        for i, (begin, size) in enumerate(zip(first[at : at + 128], wide, strict=True)):
            added[i, :size] = sources[begin : begin + size]
        added[(added[:, :, None] == edges[some][:, None, :]).any(axis=2)] = -1
        both = np.concatenate([edges[some], added], axis=1)
        full = (both >= 0).sum(axis=1) > DEGREE
        if full.any():
            edges[some[full]] = robust_prune(some[full], both[full], vectors, DEGREE, RELAX)
        if not full.all():
            rest = both[~full]
            edges[some[~full]] = -np.sort(-rest, axis=1)[:, :DEGREE]


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) without null, zero, non-finite or odd-sized vectors."""
    e = F.col("embedding")
    sound = (
        vectors.select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & e.isNotNull())
        .filter(
            F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0)
        )
    )
    usual = sound.groupBy(F.size(e).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return sound.filter(F.size(e) == (usual["size"] if usual else 0)).distinct()


def length_band(embedding: Column) -> Column:
    """The logarithm of a vector's length in steps of BAND doublings; none is out of range."""
    largest = F.array_max(F.transform(embedding, F.abs))
    squares = F.aggregate(
        F.transform(embedding, lambda x: x / largest), F.lit(0.0), lambda total, x: total + x * x
    )
    return F.floor((F.log2(largest) + F.log2(squares) / 2) / BAND).cast("int")


def _shards(bands: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int]], int]:
    """(band, its first shard, its shards) for (band, vectors), and the number of all shards."""
    total = sum(n for _, n in bands)
    wanted = max(LEAST_SHARDS, math.ceil(total / SHARD_VECTORS))
    out, first = [], 0
    for band, n in sorted(bands):
        parts = -(-n * wanted // total)
        out.append((band, first, parts))
        first += parts
    return out, first


def build_index(vectors: DataFrame, keep: int) -> tuple[DataFrame, int]:
    """One row per shard: vectors, the ids of each (the ``keep`` smallest) and the graph; and
    the number of shards.

    Equal vectors are one node, so thousands of copies neither crowd a beam nor a task.
    ``vectors`` is that of :func:`usable`.
    """

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("first")
        exact = np.array(batch["embedding"].tolist(), np.float64)
        edges, entry = build_graph(same_length(exact))
        ids = [np.sort(x) for x in batch["ids"]]
        row = {
            "shard": [batch["shard"].iloc[0]],
            "entry": [entry],
            "dim": [exact.shape[1]],
            "vectors": [exact.tobytes()],
            "edges": [edges.tobytes()],
            "ids": [np.concatenate(ids).astype(np.int64).tobytes()],
            "sizes": [np.array([len(x) for x in ids], np.int64).tobytes()],
        }
        return pd.DataFrame(row)

    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = (
        vectors.withColumn("place", F.row_number().over(smallest))
        .filter(F.col("place") <= keep)
        .groupBy("embedding")
        .agg(F.collect_list("vec_id").alias("ids"), F.min("vec_id").alias("first"))
    )
    nodes = nodes.withColumn("band", length_band(F.col("embedding")))
    # Doubles have some 1,100 bands, so the counts and their table are small at any size.
    counted = [tuple(r) for r in vectors.groupBy(length_band(F.col("embedding"))).count().collect()]
    layout, shards = _shards(counted)
    bands = vectors.sparkSession.createDataFrame(layout, "band int, at int, parts int")
    index = stored(
        nodes.join(F.broadcast(bands), "band")
        .withColumn("shard", (F.col("at") + F.pmod(F.xxhash64("first"), "parts")).cast("int"))
        .groupBy("shard")
        .applyInPandas(
            build,
            "shard int, entry int, dim int, vectors binary, edges binary, ids binary, sizes binary",
        ),
        "index",
    )
    return index, shards


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found per query.

    ``vectors`` and ``queries`` hold vec_id and embedding. A query never finds its own id;
    equal scores are ranked by vec_id; with fewer candidates than ``k`` all are returned.
    Vectors may have any lengths. Rows without a usable vector or id take no part, on either side.
    Repeated rows count once. Other columns are ignored.
    """

    def search(_: tuple, index: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(index) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        part = index.iloc[0]
        exact = np.frombuffer(part["vectors"], np.float64).reshape(-1, part["dim"])
        edges = np.frombuffer(part["edges"], np.int32).reshape(len(exact), -1)
        sizes = np.frombuffer(part["sizes"], np.int64)
        ids = np.frombuffer(part["ids"], np.int64)
        ends = np.cumsum(sizes)
        long = same_length(exact)
        ask = np.array(wanted["embedding"].tolist(), np.float64)
        query_ids = wanted["query_id"].to_numpy()
        out = []
        width = max(QUERY_BEAM, 2 * k)
        for at in range(0, len(ask), _BATCH):
            some = ask[at : at + _BATCH]
            scale = np.abs(some).max(axis=1, keepdims=True)
            flat = np.concatenate([some / scale, np.zeros((len(some), 1))], axis=1).astype(np.float32)
            beams, _ = beam_search(flat, long, edges, int(part["entry"]), width)
            for i, beam in enumerate(beams):
                beam = beam[beam >= 0]
                if len(beam) < min(width, len(exact)):  # not all is reached: look at everything
                    beam = np.arange(len(exact))
                scores = exact[beam] @ some[i]
                members = sizes[beam]
                picked = np.concatenate([ids[ends[b] - sizes[b] : ends[b]] for b in beam])
                scores = np.repeat(scores, members)
                other = picked != query_ids[at + i]
                picked, scores = picked[other], scores[other]
                best = np.lexsort((picked, -scores))[:k]
                out.append((np.full(len(best), query_ids[at + i]), picked[best], scores[best]))
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)), strict=True)))

    vectors = usable(vectors)
    index, shards = build_index(vectors, k + 1)
    queries = usable(queries).withColumnRenamed("vec_id", "query_id")
    blocks = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    laid_out = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards - 1, 0)))))
    found = (
        laid_out.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)
