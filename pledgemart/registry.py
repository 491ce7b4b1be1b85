"""Daily table registry: columns, types and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from pledgemart import fixed_values as fv

_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class TableSchema:
    table: str
    types: dict[str, str]
    required_keys: list[str]
    dedup_keys: list[str]
    sort_keys: list[str]

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    def struct(self, *, partitioned: bool = False) -> T.StructType:
        """Spark schema; ``partitioned`` leaves out ``dt``, which then lives in the path."""
        names = [c for c in self.columns if not (partitioned and c == "dt")]
        return T.StructType([T.StructField(c, _TYPES[self.types[c]]) for c in names])


def _build(table: str) -> TableSchema:
    types = dict(pair.split() for pair in fv.SILVER_COLUMNS[table].split(","))
    required, dedup, sort = fv.SILVER_KEYS[table]
    return TableSchema(table, types, required, dedup, sort)


SCHEMAS = {table: _build(table) for table in fv.SILVER_COLUMNS}


def get_schema(table: str) -> TableSchema:
    if table not in SCHEMAS:
        raise ValueError(f"unknown table {table!r}; known: {sorted(SCHEMAS)}")
    return SCHEMAS[table]
