"""Keep-last deduplication and the write order of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def all_in_order(df: DataFrame) -> Column:
    """One value of all columns that can be sorted, in their order: it settles any tie."""
    return F.struct(*[F.col(f"`{f.name}`") for f in df.schema if _sortable(f.dataType)])


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, settle: bool = True
) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Rows that tie are taken in the order of all their columns, unless the order is known to have
    no ties. The filter on ``row_number`` lets Spark cut every group to ``n`` rows inside each task
    before the shuffle, so a key that holds much of the table costs no more than others.

    The columns settle ties one by one: as a struct they would be carried a second time in every sorted row.
    """
    rank = "__rank"
    ties = [F.asc_nulls_first(f"`{f.name}`") for f in df.schema if _sortable(f.dataType)] if settle else []
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n).drop(rank)


def keep_last(df: DataFrame, keys: Sequence[str], read_order: str = "read_order") -> DataFrame:
    """One row per key, the last one read; NULL keys are equal to each other."""
    return first_per_group(df, keys, [F.desc(read_order)], settle=False)


def sort_for_write(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.sortWithinPartitions(*[F.asc_nulls_last(k) for k in keys])
