"""Numbers and dates as the seller dashboard prints them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(value: Column, pattern: str) -> Column:
    # DecimalFormat rounds half to even on the exact binary value.
    return F.call_function("format_number", value, F.lit(pattern))


def _number_or_zero(value: Column) -> Column:
    value = value.cast("double")
    return F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value)


def krw(value: Column) -> Column:
    v = _number_or_zero(value)
    return (
        F.when(F.abs(v) >= 100_000_000, F.concat(fixed(v / 100_000_000, "#,##0.0"), F.lit("억 원")))
        .when(F.abs(v) >= 10_000, F.concat(fixed(v / 10_000, "#,##0"), F.lit("만 원")))
        .otherwise(F.concat(fixed(v, "#,##0"), F.lit("원")))
    )


def number(value: Column) -> Column:
    return fixed(_number_or_zero(value), "#,##0")


def _percent_points(value: Column) -> Column:
    v = _number_or_zero(value)
    return fixed(F.when(F.abs(v) <= 1, v * 100).otherwise(v), "0.0")


def pct(value: Column) -> Column:
    return F.concat(_percent_points(value), F.lit("%"))


def pp(value: Column) -> Column:
    return F.concat(_percent_points(value), F.lit("%p"))


def date_text(value: Column) -> Column:
    return F.coalesce(F.date_format(value, "yyyy-MM-dd"), F.lit("-"))


def dday(remaining: Column) -> Column:
    days = remaining.try_cast("double").try_cast("bigint")
    return (
        F.when(days >= 0, F.concat(F.lit("D-"), days.cast("string")))
        .when(days < 0, F.concat(F.lit("D+"), F.abs(days).cast("string")))
        .otherwise("D-")
    )


def delta_direction(delta: Column) -> Column:
    return F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat")


def delta_text(delta: Column, kind: str) -> Column:
    size = F.abs(delta)
    text = krw(size) if kind == "krw" else pp(size) if kind in ("pct", "rate") else number(size)
    return (
        F.when(delta > 0, F.concat(F.lit("+"), text))
        .when(delta < 0, F.concat(F.lit("-"), text))
        .otherwise("0")
    )


def value_text(value: Column, kind: str) -> Column:
    return krw(value) if kind == "krw" else pct(value) if kind in ("pct", "rate") else number(value)
