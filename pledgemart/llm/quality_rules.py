"""Quality rules: a few counts per text, and a likelihood ratio of hashed word n-grams.

Words and word pairs of every text are hashed into a fixed number of buckets. Two multinomials are
estimated over the buckets, one from the trusted target (the rows of ``trusted``) and one from the
whole raw corpus. A text's score is the mean over its n-grams of log(target / raw); texts below a
fixed threshold are rejected, without any draw.

Everything is column expressions: words are split once per text, and what a text needs twice is
bound once by ``_let``. The counts come from partial sums per task, one row per bucket, and go back
into the scoring as one literal array of a size that does not depend on the corpus.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.llm.common import pick

#: Buckets of n-grams, and what is added to every bucket's raw count.
BUCKETS = 1 << 14
SMOOTHING = 1.0
#: N-grams per bucket, dealt out like the raw corpus, that are added to the target: rare ones say little.
PRIOR = 1.0
#: The least mean log ratio that is kept, less NOISE times the relative error of an average bucket's target
#: count: a small target says little of each n-gram, which goes away as it grows.
THRESHOLD = -0.065
NOISE = 0.5
#: Base rule: at least so many words, and at most so many percent of them in repeated windows.
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8

_SPACE = r"[ \t-\r]+"
_SYMBOLS = r"#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def words_of(text: Column) -> Column:
    """Words between white space (space, \\t to \\r); of a null text none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def _windows(words: Column, size: int) -> Column:
    """A hash of each window of ``size`` words."""
    last = F.size(words) - size
    places = F.when(last >= 0, F.sequence(F.lit(1), F.greatest(last + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, size)))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows of ``size`` words that the text has twice or more."""
    def places(hashes: Column) -> Column:
        """Places of the windows that are not alone, ascending."""
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return _let(F.sort_array(placed), lambda s: F.sort_array(F.transform(
            F.filter(
                F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), (
                    F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                ).alias("twice"))),
                lambda x: x["twice"],
            ),
            lambda x: x["i"],
        )))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b)

    return _let(_windows(words, size), lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")
    ).otherwise(_let(places(hashes), covered)))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def measures(text: Column, words: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    whole = F.coalesce(text, F.lit(""))
    return [
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
    ]


def grams_of(words: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of all words and of all pairs of neighbouring words."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    last = F.size(words) - 1
    pairs = F.transform(
        F.when(last >= 1, F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0)))).otherwise(F.array().cast("array<int>")),
        lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(single, pairs)


class Ratios(list):
    """log(target / raw) of every bucket, and the relative error of an average bucket of the target."""

    error = 0.0


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING, prior: float = PRIOR) -> Ratios:
    """log(target / raw) of every bucket; raw counts cover all of ``docs`` (doc_id, text).

    ``trusted`` (doc_id) names the target, all of which is counted; ids that it repeats count once. Without a trusted row, or
    without words, all ratios are 0.
    """
    ids = trusted.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    # Sorted on both sides at every size: the trusted ids are not bounded, so they are not to be sent to all.
    target = ids.withColumn("trusted", F.lit(1)).hint("merge")
    grams = F.explode(_let(words_of(F.col("text")), lambda w: grams_of(w, buckets)))
    counts = (
        pick(docs, "doc_id", "text").join(target, "doc_id", "left")
        .select("trusted", grams.alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
        .collect()  # one row per bucket at most
    )
    raw, good = [smoothing] * buckets, [0] * buckets
    for row in counts:
        raw[row.bucket] += row.raw
        good[row.bucket] += row.target
    if not any(good):
        return Ratios([0.0] * buckets)
    n_raw, n_good, weight = math.fsum(raw), sum(good), prior * buckets
    out = Ratios(math.log((g + weight * r / n_raw) / (n_good + weight)) - math.log(r / n_raw) for g, r in zip(good, raw, strict=True))
    out.error = math.sqrt(buckets / n_good)
    return out


def mean_log_ratio(words: Column, ratios: list[float]) -> Column:
    """The mean over a text's n-grams, 0 for a text without words."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")  # folded into one literal
    return _let(grams_of(words, len(ratios)), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
        F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.size(g)
    ))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` (with doc_id and text, any further columns are dropped) with all measures and the verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    log_ratio, kept. A null text has no words and fails the base rule; repeated rows are judged alike.
    """
    return _judged(pick(docs, "doc_id", "text"), log_ratios(docs, trusted, buckets), threshold).drop("text")


def _judged(docs: DataFrame, ratios: Ratios, threshold: float, *keep: str) -> DataFrame:
    text = F.col("text")

    def all_of(words: Column) -> Column:
        return F.struct(*measures(text, words), mean_log_ratio(words, ratios).alias("log_ratio"))

    got = docs.withColumn("m", _let(words_of(text), all_of)).select("doc_id", "text", *keep, "m.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return got.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("log_ratio") >= threshold - NOISE * ratios.error))


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that are kept, whole and with their columns, also of names that differ in case.

    A null, empty or very short text fails the base rule; texts of any length are judged whole; repeated rows are
    judged alike; an empty table gives an empty one.
    """
    names = docs.columns
    ratios = log_ratios(docs, trusted, buckets)
    plain = docs.toDF(*(f"_{i}" for i in range(len(names))))
    body = plain.select(*(F.col(f"_{names.index(n)}").alias(n) for n in ("doc_id", "text")), F.struct("*").alias("row"))
    judged = _judged(body, ratios, threshold, "row")
    # A filter would be pushed below the measures and compute them again.
    kept = judged.select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return kept.select("row.*").toDF(*names)
