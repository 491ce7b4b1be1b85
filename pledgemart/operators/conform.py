"""From raw records to a typed table: candidate lookup, null rules, casts, schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pledgemart.functions.casts import cast_text, fill_missing
from pledgemart.functions.times import normalize_dt, now_kst, wall_time
from pledgemart.registry import TableSchema

PARENT = "_parent_"
READ_ORDER = "read_order"


def field_text(path: str, record: str = "record", parent: str = "parent") -> Column:
    """Text of one field. ``a.b`` is nested; ``_parent_x`` falls back to the wrapper's ``x``.

    Paths are case-sensitive, so ``campaignId`` and ``campaignid`` are different fields.
    """
    return _or_parent(path, F.try_variant_get(record, f"$.{path}", "string"), parent)


def _or_parent(path: str, value: Column, parent: str) -> Column:
    if path.startswith(PARENT):
        return F.coalesce(value, F.try_element_at(F.col(parent), F.lit(path.removeprefix(PARENT))))
    return value


def first_present(candidates: str | Iterable[str], default: str | None = None, **columns: str) -> Column:
    """First candidate field that is not NULL; an empty string counts as a value."""
    paths = candidates.split() if isinstance(candidates, str) else list(candidates)
    values = [field_text(p, **columns) for p in paths]
    if default is not None:
        values.append(F.lit(default))
    return F.coalesce(*values)


def read_fields(
    df: DataFrame, paths: Iterable[str], *keep: str | Column, record: str = "record", leaf: T.DataType = T.StringType()
) -> tuple[DataFrame, dict[str, str]]:
    """Add a ``fields`` column with many fields of a record, and tell where each path is in it.

    The record is cast to a struct of all wanted fields at once: looking each field up on its
    own would scan the record once per field. Numbered names keep ``campaignId`` and
    ``campaignid`` apart.
    """
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.split("."):
            node = node.setdefault(step, {})
    places: dict[str, str] = {}

    def build(node: dict, prefix: str, place: str) -> tuple[T.StructType, T.StructType]:
        named, numbered = T.StructType(), T.StructType()
        for i, (step, inner) in enumerate(node.items()):
            path, at = f"{prefix}{step}", f"{place}.f{i}"
            if inner:
                a, b = build(inner, f"{path}.", at)
            else:
                a = b = leaf
                places[path] = at
            named.add(step, a)
            numbered.add(f"f{i}", b)
        return named, numbered

    named, numbered = build(tree, "", "fields")
    return df.select(F.col(record).try_cast(named).cast(numbered).alias("fields"), *keep), places


def pick_first_present(
    records: DataFrame, candidates: Mapping[str, str | Iterable[str]], *extra: Column
) -> DataFrame:
    """``first_present`` for many columns with one pass over each record.

    Casts refer to a text several times, so the texts get a projection of their own, and the
    record itself goes no further.
    """
    lists = {n: c.split() if isinstance(c, str) else list(c) for n, c in candidates.items()}
    paths = [p for wanted in lists.values() for p in wanted]
    staged, places = read_fields(records, paths, "parent", "source_key", READ_ORDER, *extra)
    columns = [
        F.coalesce(*[_or_parent(p, F.col(places[p]), "parent") for p in wanted]).alias(name)
        for name, wanted in lists.items()
    ]
    kept = [c for c in staged.columns if c not in ("fields", "parent")]
    return staged.select(*columns, *kept)


def either_container(candidates: str, containers: tuple[str, ...] = ("raw_text", "raw")) -> list[str]:
    """Spell out ``raw.x`` candidates once per container that may hold ``x``."""
    paths: list[str] = []
    for path in candidates.split():
        if path.startswith("raw."):
            paths += [f"{c}.{path.removeprefix('raw.')}" for c in containers]
        else:
            paths.append(path)
    return paths


def enforce_schema(
    df: DataFrame,
    schema: TableSchema,
    dt: str,
    *,
    text: Mapping[str, Column],
    typed: Mapping[str, Column],
    processed_at: datetime | None = None,
) -> DataFrame:
    """One projection to the table's columns and types, keeping ``read_order`` for the dedup.

    ``text`` columns still need a cast, ``typed`` ones have their type. Null rules come
    first: a missing value is filled, a present but unreadable one becomes NULL.
    """
    typed = {
        "silver_processed_at": now_kst() if processed_at is None else wall_time(processed_at),
        "dt": F.lit(normalize_dt(dt)),
        **typed,
    }
    columns = []
    for name, dtype in schema.types.items():
        if name in typed:
            value = fill_missing(name, typed[name], as_text=False)
        elif name in text:
            value = cast_text(fill_missing(name, text[name], as_text=True), dtype)
        else:
            value = F.lit(None)
        columns.append(value.cast(dtype).alias(name))
    return df.select(*columns, READ_ORDER)


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])
