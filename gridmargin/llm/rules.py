"""Quality rules whose cutoffs carry a guarantee, in DataFrame functions alone.

Every rule compares a share of a text with a cutoff. On labelled good texts, the exact
binomial distribution tests whether a cutoff rejects more than its allowance of them. Per
stratum and rule the cutoffs are tested from lax to strict up to the first that can't be
certified (a fixed sequence needs no correction), and the error is split over all strata and
rules (Bonferroni). So with the stated confidence no stratum loses more good texts than
``risk`` to all rules together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmargin.llm.common import stored, table

# Fixed values. Rule: numerator, denominator, cutoffs in thousandths from lax to strict.
RULES = {
    "symbols": ("n_symbols", "word_chars", (200, 100, 50, 20, 10, 5)),
    "upper": ("n_upper", "word_chars", (700, 500, 400, 300, 200, 150)),
    "lines": ("n_dup_lines", "n_lines", (500, 300, 200, 100)),
    "repeats": ("n_repeat_words", "n_words", (400, 300, 200, 100, 50)),
}
RISK = 0.03
ERROR = 0.1
_BLANK = r"[\x20\x09-\x0D]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_upper"]


def _packed(docs: DataFrame, taken: list[str], *more: Column) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but the text and those ``taken`` in a struct ``row``, so that no
    name can clash, its text as ``text`` and ``more`` columns; and the names of the struct."""
    names = [c for c in docs.columns if c not in ("text", *taken)]
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    row = F.struct(*quoted) if names else F.lit(None)
    return docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"), *more), names


def _fields(names: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in names]


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` without its text but with the counts that the rules need, as longs.

    Null counts as empty. Columns that have the name of a count are replaced, all others stay,
    whatever their names. Repeated windows are found by sorting window hashes with their place,
    so a text of n words costs n log n and stays in its row.
    """
    df, names = _packed(docs, COUNTS)
    word = F.col("_words")
    df = df.select(
        "*",
        F.filter(F.split("text", _BLANK + "+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    starts = F.when(F.size(word) >= 3, F.sequence(F.lit(0), F.size(word) - 3)).otherwise(
        F.array().cast("array<int>")
    )
    df = df.select(
        "row",
        F.size(word).cast("long").alias("n_words"),
        F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2])).alias("_hash"),
    )
    order = F.transform("_hash", lambda h, i: F.struct(h.alias("hash"), i.cast("long").alias("at")))
    df = df.withColumn("_order", F.sort_array(order))

    def repeated(key: Column, i: Column) -> Column:
        before, after = F.get(F.col("_order"), i - 1), F.get(F.col("_order"), i + 1)
        same = [F.coalesce(key["hash"] == other["hash"], F.lit(False)) for other in (before, after)]
        return same[0] | same[1]

    places = F.transform(F.filter("_order", repeated), lambda key: key["at"])
    df = df.withColumn("_places", F.sort_array(places))
    # Each repeated window covers three words, less those the window before it covers too.
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3).cast("long"), at - acc["last"])).alias("n"), at.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", covered).select(*_fields(names), *COUNTS)


def breaks(rule: str, cutoff: Column | int) -> Column:
    """Whether a row's share is over the cutoff; in whole numbers, so exact."""
    above, below, _ = RULES[rule]
    return F.col(above) * 1000 > F.col(below) * cutoff


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of Binomial(n, p), summed in logarithms; 1 where k >= n p."""
    odds = math.log(p / (1 - p))
    first = n * math.log(1 - p)
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(first.alias("term"), F.lit(float("-inf")).alias("sum")),
        lambda acc, j: F.struct(
            (acc["term"] + F.log((n - j) / (j + 1)) + odds).alias("term"),
            (
                F.greatest(acc["sum"], acc["term"])
                + F.log1p(F.exp(-F.abs(acc["sum"] - acc["term"])))
            ).alias("sum"),
        ),
        lambda acc: F.exp(acc["sum"]),
    )
    return F.when(k < n * p, total).otherwise(1.0)


def certified_cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per ``stratum`` of labelled good rows with a certified cutoff per rule, or null."""
    tallies = stored(
        good.groupBy("stratum").agg(
            F.count(F.lit(1)).alias("n"),
            *[
                F.count_if(breaks(rule, cutoff)).alias(f"{rule}_{cutoff}")
                for rule, (_, _, cutoffs) in RULES.items()
                for cutoff in cutoffs
            ],
        ),
        "tallies",
    )
    tests = max(1, tallies.count() * len(RULES))
    rows = [
        F.struct(
            F.lit(rule).alias("rule"), F.lit(cutoff).alias("cutoff"), F.col(f"{rule}_{cutoff}").alias("k")
        )
        for rule, (_, _, cutoffs) in RULES.items()
        for cutoff in cutoffs
    ]
    tail = binomial_tail(F.col("k"), F.col("n"), risk / len(RULES))
    sequence = (
        Window.partitionBy("stratum", "rule")
        .orderBy(F.desc("cutoff"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    passed = (
        tallies.select("stratum", "n", F.inline(F.array(*rows)))
        .withColumn("passed", tail <= error / tests)
        .withColumn("passed", F.bool_and("passed").over(sequence))
        .filter("passed")
    )
    return passed.groupBy("stratum").agg(
        *[
            F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}")
            for rule in RULES
        ]
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: Column) -> DataFrame:
    """The counts of every row of ``docs`` with ``base_failed`` and ``kept``.

    Good rows are those labelled with quality 1 that pass the base test. A stratum without
    enough of them gets no cutoff, so its rows are judged by the base test alone; a null
    stratum is one like any other. Repeated rows are judged alike. Columns named as a count,
    ``base_failed`` or ``kept`` are replaced, all others stay.
    """
    df, names = _packed(
        docs,
        [*COUNTS, "base_failed", "kept"],
        F.col("doc_id"),
        F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"),
    )
    df = text_counts(df)
    df = stored(
        df.withColumn(
            "base_failed",
            (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        ),
        "counts",
    )
    liked = labels.filter("quality = 1").select("doc_id").distinct()
    cutoffs = certified_cutoffs(df.filter("not base_failed").join(liked, "doc_id", "left_semi"))
    broken = [
        F.coalesce(breaks(rule, F.col(f"cut_{rule}")), F.lit(False)) for rule in RULES
    ]
    failed = broken[0]
    for one in broken[1:]:
        failed = failed | one
    return (
        df.join(cutoffs, "stratum", "left")
        .withColumn("kept", ~(F.col("base_failed") | failed))
        .select(*_fields(names), *COUNTS, "base_failed", "kept")
    )


def op9_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, strata by language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = judge(docs, table(spark, sf_dir, "labels"), F.col("lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def _values(name: str, rule: str) -> str:
    above, below, cutoffs = RULES[rule]
    return ", ".join(f"('{rule}', {c})" for c in cutoffs) if name == "grid" else (
        f"WHEN '{rule}' THEN {above} * 1000 > {below} * cutoff"
    )


OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    row_number() OVER () AS row_id FROM documents
), w AS (
  SELECT row_id, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d
), grams AS (
  SELECT row_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
), repeated AS (
  SELECT row_id, i FROM (
    SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS o(k) GROUP BY row_id
), f AS (
  SELECT doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (row_id) LEFT JOIN covered USING (row_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
), grid(rule, cutoff) AS (VALUES {", ".join(_values("grid", r) for r in RULES)}
), good AS (
  SELECT * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
), tally AS (
  SELECT stratum, rule, cutoff, count(*) AS n,
    count(*) FILTER (CASE rule {" ".join(_values("case", r) for r in RULES)} END) AS k
  FROM good, grid GROUP BY ALL
), tested AS (
  SELECT stratum, rule, cutoff, CASE WHEN k < n * {RISK / len(RULES)} THEN (
      SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
        + j * ln({RISK / len(RULES)}) + (n - j) * ln(1 - {RISK / len(RULES)})))
      FROM unnest(range(0, k + 1)) AS u(j)) ELSE 1 END
    <= {ERROR} / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM good)) AS ok
  FROM tally
), passed AS (
  SELECT stratum, rule, cutoff,
    bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC ROWS UNBOUNDED PRECEDING) AS ok
  FROM tested
), cuts AS (
  SELECT stratum, {", ".join(f"min(cutoff) FILTER (rule = '{r}') AS cut_{r}" for r in RULES)}
  FROM passed WHERE ok GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(f"coalesce({a} * 1000 > {d} * cut_{r}, false)" for r, (a, d, _) in RULES.items())}) AS kept
FROM b LEFT JOIN cuts USING (stratum)
"""
