"""Quality rules: base measures and a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hash buckets are counted: one over every row of
the corpus, one over trusted documents.  A document's score is the mean, over its
n-grams, of the log ratio of trusted to raw probability (shrunk by
``SHRINK`` n-grams towards 0); it is kept if the score is at least ``LEAST_SCORE``
and the base rules do not fail it.

N-grams: each word; the last two characters of each word; and each pair of
neighbours, as the last character of one and the first of the other, or as
"repeated" where both are the same word.

Trusted are rows of ``labels`` with quality 1 that are not toxic, about
``TRUSTED_ROWS`` of them at the most (a bounded sample of labelled rows, so
that their ids can be broadcast); raw counts cover all rows.  The weights are
one number per bucket, whatever the corpus.

Only DataFrame expressions are used.  Repeated 8-word windows are found inside the
row by sorting hashes of its windows (64 bits), so no text or window is shuffled.

Defined cases: a null or empty text has no words and fails the base rules.  Without
trusted rows every score is 0.  Repeated rows are judged alike, and count as often
as they stand there; several label rows of one document count once, and it is
trusted only if none of them objects.  Extra columns of either table are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .features import WHITE, bounded_sample, constant, words

BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000
SHRINK = 20
LEAST_SCORE = -0.15
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Places of a window that are compared first.
THREE = (0, 3, WINDOW - 1)
LEAST_WORDS, MOST_REPEATED_PER_CENT = 20, 30


def buckets(x: Column, before: Column) -> list[Column]:
    """The buckets of a word's n-grams; ``before`` is the word before it, null for the first."""
    joint = (F.when(before.isNull(), F.xxhash64(F.lit(3))).when(before == x, F.xxhash64(F.lit(4)))
             .otherwise(F.xxhash64(F.substring(before, -1, 1), F.substring(x, 1, 1), F.lit(2))))
    return [F.pmod(h, F.lit(BUCKETS)).cast("int") for h in (F.xxhash64(x), F.xxhash64(F.substring(x, -2, 2), F.lit(1)), joint)]


def fit(documents: DataFrame, labels: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """Log ratio of trusted to raw probability, per bucket (add-one smoothing)."""
    trusted = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
               .agg(F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))).alias("trusted"))
               .filter("trusted"))
    neighbours = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0)))).alias("p"),
                              F.col("w").alias("x"))
    counted = (documents.select("doc_id", words(F.col("text")).alias("w"))
               .join(F.broadcast(bounded_sample(trusted, trusted_rows)), "doc_id", "left")
               # the outer form: for the inner one the planner pushes a copy of the word expression into a filter
               .select(F.col("trusted").isNotNull().cast("long").alias("t"), F.inline_outer(neighbours).alias("p", "x"))
               .filter("x is not null").select("t", F.explode(F.array(*buckets(F.col("x"), F.col("p")))).alias("bucket"))
               .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("trusted")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, t in counted.collect():  # one row per bucket at the most
        raw[bucket], target[bucket] = n, t
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def repeated_words(windows: Column) -> Column:
    """Words inside windows whose hash stands twice or more in the sorted (hash, place) array ``windows``."""
    same = lambda x, i: (F.coalesce(F.get(windows, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(windows, i + 1)["h"] == x["h"], F.lit(False)))
    return F.array_sort(F.transform(F.filter(windows, same), lambda x: x["at"]))


def measures(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns in ``keep``, the words ``w`` and the base measures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    gone = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    first = documents.select("doc_id", *keep, words(F.col("text")).alias("w"), lines.alias("lines"),
                             gone(SYMBOLS).cast("long").alias("n_symbols"))
    second = first.select("doc_id", *keep, "w", F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", F.size("w").cast("long").alias("n_words"),
                          (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                          F.transform("w", lambda x: F.xxhash64(x)).alias("wh"))
    count = F.size("wh") - F.lit(WINDOW - 1)
    later = lambda c, k: F.slice(c, F.lit(1 + k), F.greatest(F.size("wh") - k, F.lit(0)))
    mixed = lambda a, b: a.bitwiseXOR(F.shiftleft(b, 7)).bitwiseXOR(F.shiftrightunsigned(b, 57))
    three = F.zip_with(F.zip_with("wh", later("wh", THREE[1]), mixed), later("wh", THREE[2]), mixed)
    three = F.slice(three, F.lit(1), F.greatest(count, F.lit(0)))  # the others are null
    hashes = F.when(count < 2, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: F.xxhash64(*(F.get(F.col("wh"), i + k) for k in range(WINDOW)))))
    alone = lambda c: F.size(F.array_distinct(c)) == F.size(c)
    # a repeated window repeats its first, fourth and last word: most texts repeat no such three, and need no more
    third = second.select("*", three.alias("h3"))
    third = third.select("*", F.when(alone("h3"), F.array().cast("array<bigint>")).otherwise(hashes).alias("h")).drop("wh", "h3")
    repeats = F.when(alone("h"), F.array().cast("array<struct<h:bigint,at:int>>")).otherwise(
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at")))))
    fourth = third.select("*", repeats.alias("r")).drop("h")
    fifth = fourth.select("*", repeated_words(F.col("r")).alias("p")).drop("r")
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("p"), i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return fifth.select("doc_id", *keep, "w", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def _judged(documents: DataFrame, weights: np.ndarray, keep: tuple[str, ...], least_score: float) -> DataFrame:
    table = constant(weights, "float")
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("string").alias("before"))
    total = F.aggregate("w", begin, lambda a, x: F.struct(
        sum((F.get(table, b) for b in buckets(x, a["before"])), a["sum"]).alias("sum"), x.alias("before")), lambda a: a["sum"])
    scored = measures(documents, *keep).select("*", total.alias("total"), (F.lit(3) * F.size("w")).alias("grams")).drop("w")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PER_CENT * F.col("n_words"))
    return (scored.withColumn("llr", F.col("total") / (F.col("grams") + SHRINK)).drop("total", "grams")
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= least_score)))


def judge(documents: DataFrame, weights: np.ndarray, *keep: str, least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per document: doc_id, ``keep``, the base measures, base_failed, llr, kept.

    The result is written once: were it only a plan, a filter on it would be
    pushed down with copies of the expressions that it filters on.
    """
    return stored(_judged(documents, weights, keep, least_score), "quality-verdicts")


def kept_rows(documents: DataFrame, weights: np.ndarray, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns; nothing is written.

    Rejected rows become null inside a generator, whose result no filter is pushed through.
    """
    judged = _judged(documents.select(F.struct("*").alias("row"), "doc_id", "text"), weights, ("row",), least_score)
    return (judged.select(F.explode_outer(F.array(F.when(F.col("kept"), F.col("row")))).alias("row"))
            .filter("row is not null").select("row.*"))
