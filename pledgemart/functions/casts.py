"""Casts from text that turn bad values into NULL, and null rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pledgemart import fixed_values as fv

# Every character Python's str.strip() removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Checked before a cast: a failed cast costs an exception, and Java reads "12d" as a number.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole numbers only: '12' and '12.0' give 12, '12.5' and 'abc' give NULL."""
    number = text.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint")).when(text.rlike(_NUMBER), whole)


def to_boolean(text: Column) -> Column:
    word = F.lower(strip(text))
    return F.when(word.isin(fv.TRUE_WORDS), F.lit(True)).when(word.isin(fv.FALSE_WORDS), F.lit(False))


def fill_missing(name: str, value: Column, *, as_text: bool) -> Column:
    """Null rule of a column, applied before its cast: only a *missing* value is filled."""
    if name in fv.ZERO_WHEN_MISSING:
        default = "0" if as_text else 0
    elif name in fv.EMPTY_WHEN_MISSING:
        default = ""
    elif name in fv.FALSE_WHEN_MISSING:
        default = "false" if as_text else False
    else:
        return value
    return F.coalesce(value, F.lit(default))


def cast_text(value: Column, dtype: str) -> Column:
    from pledgemart.functions.times import to_kst

    casts = {"bigint": to_long, "double": to_double, "boolean": to_boolean, "timestamp_ntz": to_kst}
    return casts[dtype](value) if dtype in casts else value
