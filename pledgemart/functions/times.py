"""Dates and times. Stored times are Korean wall time without a zone."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import strip

_COMPACT = re.compile(r"\d{8}")
_DASHED = re.compile(r"\d{4}-\d{2}-\d{2}")
# Spellings the timestamp cast does not know.
_EXTRA_FORMATS = [
    "yyyy/M/d HH:mm:ss", "yyyy/M/d HH:mm", "yyyy/M/d",
    "yyyy.M.d HH:mm:ss", "yyyy.M.d HH:mm", "yyyy.M.d",
]


def normalize_dt(value: str | date) -> str:
    """``YYYYMMDD`` from a compact, dashed or ISO date; raises ValueError otherwise."""
    text = str(value).strip()
    if _COMPACT.fullmatch(text):
        return text
    if _DASHED.fullmatch(text):
        return text.replace("-", "")
    try:
        return datetime.fromisoformat(text).strftime("%Y%m%d")
    except ValueError:
        pass
    for layout in ("%Y/%m/%d", "%Y.%m.%d", "%Y/%m/%d %H:%M:%S"):
        try:
            return datetime.strptime(text, layout).strftime("%Y%m%d")
        except ValueError:
            continue
    raise ValueError(f"not a date: {value!r}")


def dashed_dt(value: str | date) -> str:
    dt = normalize_dt(value)
    return f"{dt[:4]}-{dt[4:6]}-{dt[6:]}"


def normalize_dt_column(text: Column) -> Column:
    """Column form of ``normalize_dt``; NULL where the text is no date."""
    value = strip(text)
    return (
        F.when(value.rlike(r"^\d{8}$"), value)
        .when(value.rlike(r"^.{4}-.{2}-.{2}$"), F.replace(value, F.lit("-"), F.lit("")))
        .otherwise(F.date_format(parse_instant(value), "yyyyMMdd"))
    )


def parse_instant(text: Column) -> Column:
    """A moment from text: ISO with or without offset (naive is UTC), epoch seconds or millis, yyyyMMdd."""
    value = strip(text)
    number = value.try_cast("bigint")
    digits = (
        F.when(F.length(value) == 13, F.timestamp_millis(number))
        .when(F.length(value) == 10, F.timestamp_seconds(number))
        .when(F.length(value) == 8, F.try_to_timestamp(value, F.lit("yyyyMMdd")))
        .when(F.length(value) == 14, F.try_to_timestamp(value, F.lit("yyyyMMddHHmmss")))
    )
    extra = F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in _EXTRA_FORMATS])
    return (
        F.when(value.rlike(r"^\d+$"), digits)
        .when(value.rlike(r"^\d{4}-"), value.try_cast("timestamp"))
        .when(value.rlike(r"^\d{4}[/.]"), extra)
    )


def utc_to_kst(utc_wall: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), utc_wall)


def to_kst(text: Column) -> Column:
    return utc_to_kst(parse_instant(text).cast("timestamp_ntz"))


def now_kst() -> Column:
    return utc_to_kst(F.current_timestamp().cast("timestamp_ntz"))


def wall_time(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(dt: str) -> Column:
    return wall_time(datetime.strptime(dt, "%Y%m%d"))


def kst_from_path(source_key: Column, dt: str) -> Column:
    """Snapshot time of a landed file: its day plus the UTC hour in its path, in Korean time."""
    hour = F.regexp_extract(source_key, fv.HOUR_IN_PATH, 1)
    hour = F.when(hour == "", F.lit("00")).otherwise(hour)
    text = F.concat(F.lit(dashed_dt(dt) + " "), hour, F.lit(":00:00"))
    return utc_to_kst(text.try_cast("timestamp_ntz"))


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("bigint")
