"""Exact interpolated median per group without collecting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Rank error of the sketch and distance of the bracket from the middle, as shares of a group's rows.
_ACCURACY = 10_000
_REACH = 10 / _ACCURACY


def middle_values(df: DataFrame, group: str, value: str) -> DataFrame:
    """``g, v, n, total, skipped``: the distinct values near the middle with their counts.

    A quantile sketch brackets the middle ranks of each group: its rank is off by a ten-thousandth
    of the rows at most, the bracket reaches ten times as far. How the values are spread, or that
    one is far from all others, makes no difference. ``skipped`` rows lie below the bracket.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    ends = F.percentile_approx("v", F.array(F.lit(0.5 - _REACH), F.lit(0.5 + _REACH)), F.lit(_ACCURACY))
    bounds = rows.groupBy(F.col("g").alias("of")).agg(ends.alias("ends"), F.count(F.lit(1)).alias("total"))
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.join(bounds, F.equal_null("g", "of")).select(
        "g", "v", "n", "total", F.get("ends", F.lit(0)).alias("low"), F.get("ends", F.lit(1)).alias("high")
    )
    below = placed.groupBy(F.col("g").alias("of")).agg(
        F.coalesce(F.sum(F.when(F.col("v") < F.col("low"), F.col("n"))), F.lit(0)).alias("skipped")
    )
    near = placed.where(F.col("v").between(F.col("low"), F.col("high")))
    return near.join(below, F.equal_null("g", "of")).select("g", "v", "n", "total", "skipped")


def exact_median(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Median as the mean of the two middle values; NULLs are ignored.

    Values are reduced to counts per distinct value, and only those near the middle are ranked.
    """
    within = Window.partitionBy("g").orderBy("v")
    ranked = middle_values(df, group, value).withColumn("upto", F.col("skipped") + F.sum("n").over(within))
    low_rank = F.floor((F.col("total") + 1) / 2)
    high_rank = F.floor((F.col("total") + 2) / 2)
    holds = lambda rank: (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
    return ranked.groupBy(F.col("g").alias(group)).agg(
        ((F.max(F.when(holds(low_rank), F.col("v"))) + F.max(F.when(holds(high_rank), F.col("v")))) / 2).alias(name)
    )
