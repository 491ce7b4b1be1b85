"""Guarded ratios and labels used by the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def total_of(*values: Column) -> Column:
    return reduce(lambda a, b: a + b, [or_zero(v) for v in values])


def days_left_label(remaining_day: Column) -> Column:
    return (
        F.when(remaining_day < 0, "ended")
        .when(remaining_day == 0, "D-day")
        .otherwise(F.concat(F.lit("D-"), remaining_day.cast("string")))
    )


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; NULL counts as not holding."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def has_campaign_id(df_column: Column) -> Column:
    return df_column.try_cast("bigint").isNotNull()
