"""Days that are delivered in parts, and medians from sketches of days."""

import json
import os

from pyspark.sql import functions as F

from pledgemart.operators import sketches
from pledgemart.sources import landing
from pledgemart.sources.ledger import list_files, update_day

DT = "2026-05-10"


def conform(records):
    read = lambda name: F.try_variant_get("record", f"$.{name}", "bigint").alias(name)
    return records.select(read("k"), read("v"), "read_order")


def land(base, name, rows, folder="dt=20260510"):
    path = base / "preorder" / folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in rows))
    return path


def test_parts_merge_to_what_a_full_run_gives(spark, tmp_path):
    def run(n, held=None, ledger=None):
        day = update_day(spark, str(tmp_path), "preorder", DT, ["k"], conform, held, ledger)
        day.rows.write.parquet(str(tmp_path / f"rows{n}"))
        held = spark.read.parquet(str(tmp_path / f"rows{n}"))
        whole = update_day(spark, str(tmp_path), "preorder", DT, ["k"], conform).rows
        values = lambda df: sorted(map(tuple, df.select("k", "v").collect()), key=repr)
        assert values(held) == values(whole)
        return held, day.ledger, day.files_read

    held, ledger, read = run(0)
    assert read == 0 and held.count() == 0
    land(tmp_path, "m.jsonl", [(1, 10), (2, 20), (None, 5)])
    held, ledger, read = run(1, held, ledger)
    assert read == 1
    # One part before, one behind, one in the folder of the other spelling.
    land(tmp_path, "a b.jsonl", [(1, 11), (3, 30)])
    land(tmp_path, "z.json", [(2, 22), (None, 6)])
    land(tmp_path, "a.jsonl", [(3, 33)], "dt=2026-05-10")
    held, ledger, read = run(2, held, ledger)
    assert read == 3 and (1, 10) in {(r.k, r.v) for r in held.collect()}
    held, ledger, read = run(3, held, ledger)
    assert read == 0
    land(tmp_path, "z.json", [(2, 222), (4, 40)])  # a known file that changes: rows it had displaced come back
    held, ledger, read = run(4, held, ledger)
    assert read == 4 and (None, 5) in {(r.k, r.v) for r in held.collect()}
    os.remove(tmp_path / "preorder" / "dt=20260510" / "a b.jsonl")
    assert run(5, held, ledger)[2] == 3


def test_listing_opens_no_file_and_a_limited_read_no_other(spark, tmp_path):
    kept = land(tmp_path, "a.jsonl", [(1, 1)])
    land(tmp_path, "b.jsonl", [(2, 2)])
    listed = list_files(spark, str(tmp_path), "preorder", DT)
    assert "ReadSchema: struct<>" in listed._jdf.queryExecution().executedPlan().toString() and listed.count() == 2
    path = [r.path for r in listed.collect() if r.path.endswith("/a.jsonl")]
    some = landing.read_records(spark, str(tmp_path), "preorder", DT, files=path)
    assert [r.source_key for r in some.collect()] == path and kept.exists()
    assert landing.read_records(spark, str(tmp_path), "preorder", DT, files=[]).count() == 0


def test_merged_sketches_stay_near_the_middle(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 7).cast("string").alias("dt"), F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("g"),
        F.when(F.col("id") % 11 > 0, F.pow(F.rand(5), 9)).alias("v"),
    ).union(spark.createDataFrame([("1", "none", None), ("1", "one", 4.0), ("2", "one", 8.0), ("3", "one", 9.0)], "dt string, g string, v double")).cache()
    stored = sketches.day_sketches(rows, ["dt", "g"], "v")
    assert stored.where("g = 'hot'").count() == 7
    got = {r.g: r for r in sketches.merged_quantile(stored, "g", "median").collect()}
    assert set(got) == {"hot", "b", "one"} and got["one"].median == 8.0 and got["one"].n == 3
    for g in ("hot", "b"):
        values = [r.v for r in rows.where((F.col("g") == g) & F.col("v").isNotNull()).collect()]
        below = sum(v < got[g].median for v in values) / len(values)
        assert got[g].n == len(values) and abs(below - 0.5) <= 2 * sketches.rank_error()
    assert sketches.merged_quantile(stored.limit(0), "g", "median").count() == 0
