"""Totals over a long history from one mergeable partial per campaign and day.

Sums of days add up, distinct users do not: a user of two days counts once. A partial therefore holds its
users as bits, at numbers that a table of all users gives them, and merging days is an OR. Bits lie in
buckets of 64 numbers, one row each and a number per condition: a campaign with very many users is spread
over rows and tasks, and one with few of many users holds a number for each, not a bitmap that is all but
empty. A new day is reduced once; the history is never read again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.functions.pii import packed, unpacked

#: Numbers that the partitions of one numbering may use together; a later numbering starts above them.
_STEP = 1 << 43
#: A bucket has 2 ** 6 numbers, as many as a bigint has bits.
_BUCKET_BITS = 6


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``user_id_hash, user_no`` of users that ``known`` does not have: numbers of their own, dense within a task.

    Append the result to ``known``. A NULL user has no number.
    """
    new = users.select(packed(F.col("user_id_hash")).alias("user")).where(F.col("user").isNotNull()).distinct()
    start = 0
    if known is not None:
        new = new.join(known.select(packed(F.col("user_id_hash")).alias("user")), "user", "left_anti")
        most = known.agg(F.max("user_no")).first()[0]
        start = 0 if most is None else (most // _STEP + 1) * _STEP
    # Numbers start from 1.
    return new.select(unpacked(F.col("user")).alias("user_id_hash"), (F.monotonically_increasing_id() + F.lit(start + 1)).alias("user_no"))


def day_partials(
    rows: DataFrame, numbers: DataFrame, users: Mapping[str, Column], sums: Mapping[str, Column], keys: tuple[str, ...] = ("dt", "campaign_id")
) -> DataFrame:
    """One row per key and bucket: the bits of the users for whom each condition of ``users`` holds, and ``sums``.

    Conditions are read per row; a user of whom one row holds is in. Rows without a user only add to the sums.
    """
    held = rows.select(*keys, packed(F.col("user_id_hash")).alias("user"), *(c.alias(n) for n, c in (users | sums).items()))
    placed = held.join(numbers.select(packed(F.col("user_id_hash")).alias("user"), "user_no"), "user", "left")
    # A hot campaign is spread over its buckets.
    bucket = F.shiftright("user_no", _BUCKET_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("user_no").bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1)).cast("int"))
    return placed.groupBy(*keys, bucket.alias("bucket")).agg(
        *(F.bit_or(F.when(F.col(n), bit)).alias(n) for n in users), *(F.sum(n).alias(n) for n in sums)
    )


def merge_partials(partials: DataFrame, users: list[str], sums: list[str], key: str = "campaign_id") -> DataFrame:
    """Distinct users per condition, and sums, over all days of ``partials``."""
    per_bucket = partials.groupBy(key, "bucket").agg(*(F.bit_or(n).alias(n) for n in users), *(F.sum(n).alias(n) for n in sums))
    # Of a bucket nobody of whom meets a condition the bits are NULL, as they are without a user.
    count = lambda n: F.sum(F.coalesce(F.bit_count(n), F.lit(0))).alias(n)
    return per_bucket.groupBy(key).agg(*map(count, users), *(F.sum(n).alias(n) for n in sums))
