"""Operators over a campaign's ordered observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pledgemart.functions.measures import ratio
from pledgemart.operators.dedup import first_per_group


def with_previous(df: DataFrame, key: str, order: str, columns: Mapping[str, str]) -> DataFrame:
    """Add the previous *observed* value of each column under the given name, in one window."""
    window = Window.partitionBy(key).orderBy(F.asc_nulls_last(order))
    return df.select("*", *[F.lag(c).over(window).alias(name) for c, name in columns.items()])


def change(current: str, previous: str):
    return F.col(current) - F.col(previous)


def change_rate(current: str, previous: str):
    """Relative change; NULL if the previous value is NULL or 0."""
    return ratio(F.col(current) - F.col(previous), F.col(previous))


def latest_and_previous(
    df: DataFrame, key: str, date: str, values: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Per key: each value at its latest date and at the date before, as ``x`` and ``prev_x``.

    Rows without a date are left out. ``tie_break`` names columns that pick the last row of
    a date, for tables with several rows per key and date.
    """
    dated = df.where(F.col(date).isNotNull()).select(key, date, *tie_break, *values)
    if tie_break:
        dated = first_per_group(dated, [key, date], [F.desc_nulls_last(c) for c in tie_break])
    top = dated.withColumn(
        "__pos", F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(date)))
    ).where(F.col("__pos") <= 2)
    at = lambda c, pos: F.max(F.when(F.col("__pos") == pos, F.col(c)))
    return top.groupBy(key).agg(
        at(date, 1).alias("latest_date"),
        at(date, 2).alias("prev_date"),
        *[at(c, 1).alias(c) for c in values],
        *[at(c, 2).alias(f"prev_{c}") for c in values],
    )


def unpivot_metrics(
    df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Wide metric columns to rows. Columns the frame lacks are left out, labels come from ``metrics``."""
    present = [c for c in metrics if c in df.columns]
    wide = df.select(*ids, *[F.col(c).cast("double").alias(metrics[c]) for c in present])
    return wide.unpivot(list(ids), [metrics[c] for c in present], name, value)
