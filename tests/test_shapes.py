import json

from pyspark.sql import functions as F

from pledgemart import fixed_values as fv
from pledgemart.sources.shapes import field_report, known_paths


def report(spark, records, known):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "t string").select(F.parse_json("t").alias("record"))
    return {r.field: tuple(r)[1:] for r in field_report(df, known).collect()}


def test_known_unknown_and_vanished_fields(spark):
    records = [
        {"id": 1, "Id": "x", "maker": {"name": "a", "url": None, "deep": {"x": 1}}},
        {"id": 2.5, "maker": "plain", "new": [1]},
        {"id": None, "maker": {"name": "b"}},
        7,
    ]
    assert report(spark, records, ["id", "maker.name", "gone", "maker.gone"]) == {
        "id": ("known", 3, 2, "DECIMAL(21,1)"),  # wide enough for a whole number of 64 bits
        "Id": ("unknown", 1, 1, "STRING"),
        "maker": ("known", 3, 3, "VARIANT"),
        "maker.name": ("known", 2, 2, "STRING"),
        "maker.url": ("unknown", 1, 0, "VOID"),
        "maker.deep": ("unknown", 1, 1, "OBJECT<x: BIGINT>"),
        "new": ("unknown", 1, 1, "ARRAY<BIGINT>"),
        "gone": ("vanished", 0, 0, None),
        "maker.gone": ("vanished", 0, 0, None),
    }


def test_no_records_and_no_known_fields(spark):
    assert report(spark, [], ["a", "b.c"]) == {"a": ("vanished", 0, 0, None), "b.c": ("vanished", 0, 0, None)}
    assert report(spark, [{"a": None}], []) == {"a": ("unknown", 1, 0, "VOID")}


def test_paths_of_the_tables(spark):
    paths = known_paths(fv.COMMENT_FIELDS.values())
    assert paths and not any(p.startswith("_parent_") or " " in p for p in paths)
