"""Pseudonyms for user ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import blank_to_null


def salted_hash(value: Column, salt: str = "") -> Column:
    """SHA-256 hex of ``salt:value``; NULL for a missing or blank value."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), blank_to_null(value.cast("string"))), 256)


_TAIL = 33


def packed(user_id_hash: Column) -> Column:
    """Bytes that are equal for equal hashes only: 32 for 64 lower-case hex digits, 33 more than its own for any other text.

    Shuffles of users take half the bytes of the digits.
    """
    text = user_id_hash.cast("string")
    digits = F.unhex(text)
    is_hash = (F.length(text) == 64) & (F.lower(text) == text) & digits.isNotNull()
    return F.when(is_hash, digits).otherwise(F.concat(text.cast("binary"), F.lit(bytes(_TAIL))))


def unpacked(packed_hash: Column) -> Column:
    """The text that ``packed`` was given."""
    size = F.length(packed_hash)
    return F.when(size == 32, F.lower(F.hex(packed_hash))).otherwise(packed_hash.substr(F.lit(1), size - _TAIL).cast("string"))


def user_id_from_path(source_key: Column) -> Column:
    return F.nullif(F.regexp_extract(source_key, fv.USER_ID_IN_PATH, 1), F.lit(""))
