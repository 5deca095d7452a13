"""Phrases whose words belong together, counted by multikey quicksort of word suffixes.

Every word starts a suffix of at most ``depth`` words that ends with its piece of text. Suffixes
are routed by their leading words, so that all that start alike meet in one bucket. There a
three-way quicksort splits them word by word: the size of an equal partition is the count of a
phrase, and a partition below the least count is abandoned, since it holds no frequent phrase.

Suffixes that are equal within a task travel once with their number. Leading words that are
too frequent to share a bucket (``hot`` words, a bounded list) route by the words that follow;
phrases of hot words alone are summed directly.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmargin.llm.common import stored, table
from gridmargin.llm.minimisers import mix

# What ends a piece of text (a full stop stands for all of it), A-Z, and the tab.
STOP = b"."
_SPLIT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b".......... abcdefghijklmnopqrstuvwxyz")
NO_LANGUAGE = "und"

BUCKET_WORDS = 2_000_000  # suffixes of a bucket, on average at most
HOT_WORDS = 4_096  # the most words that can be hot
_CHUNK_WORDS = 2_000_000  # tokens that a task gathers before it writes
_FLUSH = 500_000  # entries of a task's counter
_hash = partial(xxhash.xxh64_intdigest, seed=11)

COUNTS = "lang string, phrase string, f long"


def tokens_of(text: str) -> list[bytes]:
    """The lower-cased words of a text and a full stop wherever a piece ends."""
    return text.encode().translate(_SPLIT).replace(STOP, b" . ").split()


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words; the count of the null word is that of all of them."""
    found: dict[str, Counter] = defaultdict(Counter)

    def flushed() -> pd.DataFrame:
        rows = []
        for lang, counter in found.items():
            counter.pop(STOP, None)
            rows.append((lang, None, counter.total()))
            rows += [(lang, word.decode(), n) for word, n in counter.items()]
        found.clear()
        return pd.DataFrame(rows, columns=["lang", "phrase", "f"])

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            found[lang].update(tokens_of(text))
        if sum(map(len, found.values())) > _FLUSH:
            yield flushed()
    yield flushed()


def suffixes(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rows of the next ``depth`` ids from every word that has a successor; 0 after a piece.

    In ``ids`` 0 stands between pieces.
    """
    padded = np.concatenate([ids, np.zeros(depth, ids.dtype)])
    columns = [ids]
    for d in range(1, depth):
        columns.append(np.where(columns[-1] == 0, 0, padded[d : d + len(ids)]))
    return np.stack(columns, axis=1)[(columns[0] != 0) & (columns[1] != 0)]


def distinct_rows(rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, sorted, and how often each occurs; ids are at most ``most``."""
    bits = max(int(most).bit_length(), 1)
    codes, held = rows[:, 0].astype(np.uint64), bits
    for column in rows.T[1:]:
        if held + bits > 64:  # ranks keep the order of the codes and need fewer bits
            codes = np.unique(codes, return_inverse=True)[1].astype(np.uint64)
            held = max(len(codes).bit_length(), 1)
        codes = (codes << np.uint64(bits)) | column.astype(np.uint64)
        held += bits
    _, first, counts = np.unique(codes, return_index=True, return_counts=True)
    return rows[first], counts


def packed(words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """The words that rows of ids use, and the rows by their places among those, compressed."""
    used = np.unique(rows)
    used = used[used > 0]
    places = np.zeros(int(used.max(initial=0)) + 1, np.uint32)
    places[used] = np.arange(1, len(used) + 1)
    columns = [places[c] for c in rows.T] + [counts]
    data = b"".join(np.ascontiguousarray(c, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return squeeze(b" ".join(words[i] for i in used)), squeeze(data)


def unpacked(words: bytes, data: bytes, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    planes = np.frombuffer(expand(data), np.uint8).reshape(depth + 1, 4, -1)
    columns = planes.transpose(0, 2, 1).copy().view("<u4")[..., 0].astype(np.int64)
    return expand(words).split(b" "), columns[:depth], columns[depth]


def _numbers() -> defaultdict[bytes, int]:
    """Numbers of words in the order of their first use, the full stop's is 0."""
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    ids[STOP]
    return ids


def _routed(
    batches: Iterator[pd.DataFrame], hot: dict[str, set[bytes]], buckets: int, depth: int
) -> Iterator[pd.DataFrame]:
    """Rows of one bucket's suffixes (lang, bucket, words, data), and of hot phrases (phrase, f)."""
    columns = ["lang", "bucket", "words", "data", "phrase", "f"]
    held: dict[str, tuple[defaultdict[bytes, int], list[np.ndarray]]] = {}
    size = 0

    def written() -> Iterator[pd.DataFrame]:
        for lang in list(held):
            ids, texts = held.pop(lang)
            words = list(ids)
            rows, counts = distinct_rows(suffixes(np.concatenate(texts), depth), len(words))
            is_hot = np.fromiter((w in hot.get(lang, ()) for w in words), bool, len(words))
            is_hot[0] = True  # what ends a suffix doesn't end a run of hot words in it
            route = np.fromiter(map(_hash, words), np.uint64, len(words))
            code = mix(route[rows[:, 0]]) + np.uint64(_hash(lang.encode()))
            open_ = is_hot[rows[:, 0]]
            for d in range(1, depth):
                # Leading words up to the first that isn't hot take part, two at least.
                takes = open_ if d > 1 else np.ones(len(rows), bool)
                alone = open_ & is_hot[rows[:, d]] & (rows[:, d] > 0)
                phrases, which = np.unique(rows[alone][:, : d + 1], axis=0, return_inverse=True)
                sums = np.bincount(which.ravel(), counts[alone], len(phrases)).astype(np.int64)
                some = [b" ".join(words[i] for i in p).decode() for p in phrases]
                if some:
                    blank = [None] * len(some)
                    yield pd.DataFrame([*zip([lang] * len(some), blank, blank, blank, some, sums, strict=True)], columns=columns)
                code = np.where(takes, mix(code ^ route[rows[:, d]]), code)
                open_ = open_ & is_hot[rows[:, d]]
            rows, counts, bucket = rows[~open_], counts[~open_], (code[~open_] % np.uint64(buckets)).astype(np.int64)
            if not len(rows):
                continue
            order = np.argsort(bucket, kind="stable")
            numbers, starts = np.unique(bucket[order], return_index=True)
            for b, mine in zip(numbers.tolist(), np.split(order, starts[1:]), strict=True):
                yield pd.DataFrame([(lang, b, *packed(words, rows[mine], counts[mine]), None, None)], columns=columns)

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if lang not in held:
                held[lang] = _numbers(), []
            ids, texts = held[lang]
            tokens = tokens_of(text)
            tokens.append(STOP)
            texts.append(np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens)))
            size += len(tokens)
            if size >= _CHUNK_WORDS:
                yield from written()
                size = 0
    yield from written()


def frequent_prefixes(
    keys: np.ndarray, weights: np.ndarray, least: int, seed: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, a pointer of each, counts) of the frequent prefixes of suffixes, from two words.

    ``keys`` has a row per place in the suffix and a column per suffix, 0 where it has ended;
    ``weights`` says how often each occurs. A multikey quicksort: every partition takes the key
    at its depth of a random pointer as pivot and splits into less, equal and greater; equal
    ones go a word deeper. All partitions take a step at once, as labels of their pointers.
    """
    depth_most, n = keys.shape
    flat = keys.ravel()
    pointer = np.random.default_rng(seed).permutation(n)
    label, depth = np.zeros(n, np.int64), np.zeros(1, np.int64)
    while len(pointer):
        pivot = np.empty(len(depth), np.int64)
        pivot[label] = pointer  # any one of each partition, in random order
        key = flat[depth[label] * n + pointer]
        side = np.sign(key - flat[depth * n + pivot][label]) + 1
        part = 3 * label + side
        size = np.bincount(part, weights[pointer], 3 * len(depth)).astype(np.int64)
        large = size >= least
        equal = np.flatnonzero(large[1::3])
        words = depth[equal] + 1
        for w in range(2, depth_most + 1):
            if (mine := equal[words == w]).size:
                yield w, pivot[mine], size[1::3][mine]
        next_depth = np.repeat(depth, 3)
        next_depth[1::3] += 1
        goes_on = large & (next_depth < depth_most)
        stays = goes_on[part]
        pointer, part = pointer[stays], part[stays]
        ended = flat[next_depth[part] * n + pointer] == 0
        pointer, part = pointer[~ended], part[~ended]
        numbers = np.zeros(len(goes_on), np.int64)
        left = np.unique(part)
        numbers[left] = np.arange(len(left))
        label, depth = numbers[part], next_depth[left]


def _bucket_counts(
    key: tuple, rows: pd.DataFrame, hot: dict[str, set[bytes]], least: int, depth: int
) -> pd.DataFrame:
    """The frequent phrases of one bucket, those of hot words alone left out."""
    lang = key[0]
    ids = _numbers()
    keys, weights = [], []
    for words, data in zip(rows["words"], rows["data"], strict=True):
        own, columns, counts = unpacked(words, data, depth)
        number = np.zeros(len(own) + 1, np.int64)
        number[1:] = np.fromiter(map(ids.__getitem__, own), np.int64, len(own))
        keys.append(number[columns].astype(np.int32))
        weights.append(counts)
    joined, weight = np.concatenate(keys, axis=1), np.concatenate(weights)
    words = list(ids)
    mine = hot.get(lang, set())
    out = []
    for length, pointers, counts in frequent_prefixes(joined, weight, least):
        for p, n in zip(joined[:length, pointers].T.tolist(), counts.tolist(), strict=True):
            phrase = [words[i] for i in p]
            if not mine.issuperset(phrase):
                out.append((lang, b" ".join(phrase).decode(), n))
    return pd.DataFrame(out, columns=["lang", "phrase", "f"])


def phrase_counts(
    docs: DataFrame, depth: int = 4, least: int = 30, bucket_words: int = BUCKET_WORDS, hot_words: int = HOT_WORDS
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, f) of 1 to ``depth`` words, and all words (lang, n).

    Null texts hold no word, a null language is ``und``, and rows that repeat count each time.
    Only numbers and the words of more than a bucket (at most ``hot_words``) reach the driver.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").filter("text <> ''")
    words = stored(
        texts.mapInPandas(_word_counts, COUNTS)
        .groupBy("lang", "phrase")
        .agg(F.sum("f").alias("f"))
        .filter((F.col("f") >= least) | (F.col("phrase").isNull() & (F.col("f") > 0))),
        "words",
    )
    totals = words.filter("phrase is null").select("lang", F.col("f").alias("n"))
    single = words.filter("phrase is not null")
    everything = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # No more than hot_words words can be as frequent as that.
    bound = max(bucket_words, everything // hot_words + 1)
    hot: dict[str, set[bytes]] = defaultdict(set)
    for r in single.filter(F.col("f") >= bound).select("lang", "phrase").collect():
        hot[r.lang].add(r.phrase.encode())
    hot = dict(hot)
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-everything // bucket_words))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _routed(batches, hot, buckets, depth)

    counted: Callable = lambda key, rows: _bucket_counts(key, rows, hot, least, depth)
    routes = stored(
        texts.mapInPandas(routed, "lang string, bucket long, words binary, data binary, phrase string, f long"),
        "suffixes",
    )
    longer = (
        routes.filter("bucket is not null")
        .select("lang", "bucket", "words", "data")
        .groupBy("lang", "bucket")
        .applyInPandas(counted, COUNTS)
    )
    of_hot = (
        routes.filter("phrase is not null")
        .groupBy("lang", "phrase")
        .agg(F.sum("f").alias("f"))
        .filter(F.col("f") >= least)
    )
    return stored(single.unionByName(longer).unionByName(of_hot), "phrases"), totals


def collocations(
    phrases: DataFrame,
    totals: DataFrame,
    most: int | None = 2000,
    depth: int = 4,
    scale: int = 2_000_000,
    inside: int = 80,
) -> DataFrame:
    """The phrases of several words by how much their parts keep to each other.

    ``phrases`` and ``totals`` are those of `phrase_counts`. A phrase scores
    floor(scale * a / (l + r)) at its lowest cut. It is dropped if a longer one that holds it
    has ``inside`` percent of its count. Returns the ``most`` best of each language.
    """
    split = phrases.withColumn("words", F.split("phrase", " ")).withColumn("k", F.size("words"))
    several = split.filter("k > 1")
    cuts = F.array(
        *[
            F.struct(
                F.lit(c).alias("cut"),
                F.array_join(F.slice("words", 1, c), " ").alias("first"),
                F.when(F.col("k") > c, F.array_join(F.slice("words", F.lit(c + 1), F.col("k") - c), " ")).alias("rest"),
            )
            for c in range(1, depth)
        ]
    )
    parts = several.select("lang", "phrase", F.col("f").alias("a"), "k", F.inline(cuts)).filter("rest is not null")
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = F.expr(f"cast(a as decimal(20,0)) * {scale} div (cast(l as decimal(20,0)) + r)")
    scored = (
        parts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(exact.alias("score"), "cut", "l", "r")).alias("at"))
    )
    inner = F.array(*[F.struct(F.lit(n).alias("size"), F.lit(at).alias("at")) for n in range(2, depth) for at in range(1, depth)])
    covers = (
        several.select("lang", "f", "words", "k", F.inline(inner))
        .filter("size < k and at + size - 1 <= k")
        .select("lang", "f", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("cover"))
    )
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = (
        scored.join(covers, ["lang", "phrase"], "left")
        .filter(F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * inside))
        .select("lang", "phrase", "a", "at.l", "at.r", "at.score")
        .withColumn("rank", F.row_number().over(ranked).cast("long"))
    )
    if most is not None:
        out = out.filter(F.col("rank") <= most)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_multikey_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of 2 to 4 words of each language, 30 occurrences at least."""
    phrases, totals = phrase_counts(table(spark, sf_dir, "documents"), depth=4, least=30)
    return collocations(phrases, totals, most=2000)


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from worded, (values (1), (2), (3), (4)) sizes(k) where len(w) >= k),
counted as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from counted where k = 1 group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k > 1 and f >= 30),
cuts as (
  select c.lang, c.phrase, c.a, c.k, cut, array_to_string(w[1:cut], ' ') as first, array_to_string(w[cut + 1:], ' ') as rest
  from candidates c, (values (1), (2), (3)) places(cut) where cut < c.k),
scored as (
  select c.lang, c.phrase, c.a, x.f as l, y.f as r, (2000000::hugeint * c.a) // (x.f + y.f) as score,
    row_number() over (partition by c.lang, c.phrase order by (2000000::hugeint * c.a) // (x.f + y.f), cut) as place
  from cuts c join counted x on x.lang = c.lang and x.phrase = c.first join counted y on y.lang = c.lang and y.phrase = c.rest),
inner_parts as (
  select lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
  from candidates, (values (2), (3)) sizes(m) where m < k),
covers as (select lang, phrase, max(a) as cover from inner_parts group by all),
kept as (
  select s.* from scored s left join covers v using (lang, phrase)
  where s.place = 1 and (cover is null or 100 * cover < 80 * s.a)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""
