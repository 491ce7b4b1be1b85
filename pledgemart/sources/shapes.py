"""What fields the landed records have, beside those the tables look for.

A source that renames a field leaves a column empty without any error. The report tells such fields from the records
themselves: those nobody looks for, and those looked for that no record has any more.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart.operators.conform import PARENT

_ENTRY = "array<struct<field: string, value: variant>>"


def known_paths(fields: Iterable[str | Iterable[str]]) -> list[str]:
    """The paths of candidate lists (text with spaces between, or lists), without those of a wrapper."""
    paths = [p for some in fields for p in (some.split() if isinstance(some, str) else some)]
    return list(dict.fromkeys(p for p in paths if not p.startswith(PARENT)))


def _entries(value: Column, prefix: Column | None = None) -> Column:
    """The fields of an object as (path, value); none for anything else."""
    name = (lambda k: k) if prefix is None else (lambda k: F.concat(prefix, F.lit("."), k))
    pairs = F.map_entries(value.try_cast("map<string,variant>"))
    held = F.transform(pairs, lambda p: F.struct(name(p["key"]).alias("field"), p["value"].alias("value")))
    return F.coalesce(held, F.array().cast(_ENTRY))


def field_report(records: DataFrame, known: Iterable[str], record: str = "record") -> DataFrame:
    """A row per field: field, status, records, filled, kind.

    ``status`` is "known" if ``known`` names the path or one within it, "unknown" if not, and "vanished" for a
    named path in no record. ``records`` counts the records with the field, ``filled`` those
    where it is not null, and ``kind`` is the type that all its values have in common. Objects are followed as deep
    as the longest known path; records that are no objects have no fields; without records all has vanished.
    """
    known = list(dict.fromkeys(known))
    depth = max((p.count(".") + 1 for p in known), default=1)
    rows = records.select(F.explode(_entries(F.col(record))).alias("entry")).select("entry.field", "entry.value", F.lit(1).alias("level"))
    for level in range(1, depth):
        # Each row stays and adds its own fields, if it came with the level before.
        inner = F.when(F.col("level") == level, _entries(F.col("value"), F.col("field")))
        here = F.struct("field", "value", "level")
        below = F.transform(F.coalesce(inner, F.array().cast(_ENTRY)), lambda e: F.struct(e["field"].alias("field"), e["value"].alias("value"), F.lit(level + 1).alias("level")))
        rows = rows.select(F.explode(F.concat(F.array(here), below)).alias("entry")).select("entry.*")
    found = rows.groupBy("field").agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(~F.is_variant_null("value"), 1)).alias("filled"),
        F.schema_of_variant_agg("value").alias("kind"),
    )
    # As long as the candidate lists. What leads to a known path is known, too, but need not be there itself.
    above = {".".join(p.split(".")[:n]) for p in known for n in range(1, p.count(".") + 1)} - set(known)
    names = [(p, True) for p in known] + [(p, False) for p in sorted(above)]
    names = records.sparkSession.createDataFrame(names, "field string, wanted boolean")
    status = F.when(F.col("records").isNull(), "vanished").when(F.col("wanted").isNull(), "unknown").otherwise("known")
    both = found.join(names, "field", "full_outer").filter("records IS NOT NULL OR wanted")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return both.select("field", status.alias("status"), zero("records"), zero("filled"), "kind")
