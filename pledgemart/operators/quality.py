"""Required keys, quality metrics and the guard on public columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.functions.casts import strip
from pledgemart.registry import TableSchema

ERROR_REASON = "_silver_error_reason"
MISSING_KEY = "missing_required_key"
PRIVATE_COLUMNS = frozenset(
    "user_id_hash author_id_hash comment_body_cleaned comment_id user_id maker_id".split()
)


def lacks_required_key(df: DataFrame, schema: TableSchema) -> Column:
    """True where a required key is NULL or blank; a missing key column fails every row."""
    tests = []
    for key in schema.required_keys:
        if key not in df.columns:
            tests.append(F.lit(True))
        else:
            tests.append(F.col(key).isNull() | (strip(F.col(key).cast("string")) == ""))
    return reduce(or_, tests, F.lit(False))


def with_error_reason(df: DataFrame, schema: TableSchema) -> DataFrame:
    """Add the reason a row is set aside for; NULL for a valid row."""
    return df.withColumn(ERROR_REASON, F.when(lacks_required_key(df, schema), F.lit(MISSING_KEY)))


def split_valid_and_error(df: DataFrame, schema: TableSchema) -> tuple[DataFrame, DataFrame]:
    marked = with_error_reason(df, schema)
    reason = F.col(ERROR_REASON)
    return marked.where(reason.isNull()).drop(ERROR_REASON), marked.where(reason.isNotNull())


def validation_metrics(df: DataFrame, schema: TableSchema) -> list[Column]:
    invalid = lacks_required_key(df, schema)
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~invalid).alias("valid_rows"),
        F.count_if(invalid).alias("error_rows"),
    ]


def null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]


def quality_metrics(df: DataFrame, schema: TableSchema) -> DataFrame:
    """One row: row count, NULLs per column, rows lost to the dedup, rows without keys.

    Taken on the conformed frame *before* dedup. Duplicates are counted by grouping on the
    keys, which spreads over tasks, rather than by one distinct over the whole table.
    """
    columns = [F.col(c) for c in schema.columns if c in df.columns]
    rows = df.select(*columns)
    per_key = rows.groupBy(*schema.dedup_keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(lacks_required_key(df, schema)).alias("keyless"),
        *[F.count_if(c.isNull()).alias(f"null_{name}") for c, name in zip(columns, rows.columns)],
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    return per_key.agg(
        total("n").alias("row_cnt"),
        (total("n") - F.count(F.lit(1))).alias("duplicate_cnt"),
        total("keyless").alias("missing_key_cnt"),
        *[total(f"null_{name}").alias(f"null_{name}") for name in rows.columns],
    )


def assert_public(df: DataFrame) -> DataFrame:
    """Refuse a public frame with user hashes, comment text or per-user rows."""
    leaked = PRIVATE_COLUMNS.intersection(df.columns)
    if leaked:
        raise ValueError(f"not public: {sorted(leaked)}")
    return df
