"""Partials of days against totals of rows, and marts that are replaced while they are read."""

import random

from pyspark.sql import functions as F

from pledgemart import sinks
from pledgemart.operators.partials import number_users
from pledgemart.plans import gold

SUPPORTER = "campaign_id string, dt string, user_id_hash string, is_purchaser boolean, is_signer boolean, backing_amount long"


def supporters(spark, days, seed=1):
    rng = random.Random(seed)
    pick = rng.choice
    return spark.createDataFrame(
        [(pick(["1", "2", "3", "no"]), day, pick([None, *(f"u{i}" for i in range(40))]), pick([None, True, False]), pick([None, True, False]), pick([None, 0, 5, 70]))
         for day in days for _ in range(120)],
        SUPPORTER,
    )


def same(a, b):
    key = lambda r: repr(sorted(r.asDict().items()))
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_merged_days_equal_totals_of_rows(spark, tmp_path):
    days = ["20240101", "20240102", "20240103"]
    rows, known = supporters(spark, days), None
    for day in days:
        some = rows.where(F.col("dt") == day)
        number_users(some, known).write.mode("append").parquet(str(tmp_path / "users"))
        known = spark.read.parquet(str(tmp_path / "users"))
        gold.supporter_partials(some, known).write.mode("append").partitionBy("dt").parquet(str(tmp_path / "partials"))
    assert known.count() == known.select("user_no").distinct().count() == rows.select("user_id_hash").distinct().where("user_id_hash IS NOT NULL").count()
    partials = spark.read.parquet(str(tmp_path / "partials"))
    assert same(gold.merged_supporter_totals(partials), gold.supporter_totals(rows))
    assert same(gold.merged_supporter_totals(partials.where("dt <= '20240102'")), gold.supporter_totals(rows, "20240102"))
    fundings = rows.withColumnRenamed("backing_amount", "amount")
    assert same(gold.merged_funding_totals(gold.funding_partials(fundings, known)), gold.funding_totals(fundings))
    none = gold.merged_supporter_totals(gold.supporter_partials(rows.limit(0), known))
    assert none.count() == 0


def test_a_new_day_reads_that_day_only(spark, tmp_path):
    supporters(spark, ["20240101", "20240102"]).write.partitionBy("dt").parquet(str(tmp_path / "rows"))
    day = spark.read.schema(SUPPORTER).parquet(str(tmp_path / "rows")).where("dt = '20240102'")
    numbers = number_users(day)
    plan = gold.supporter_partials(day, numbers)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "20240102" in plan


def test_numbers_beyond_one_bucket(spark):
    rows = spark.range(100_000).select(F.lit("7").alias("campaign_id"), F.lit("20240101").alias("dt"), F.col("id").cast("string").alias("user_id_hash"), F.lit(1).cast("long").alias("amount"))
    partials = gold.funding_partials(rows.union(rows), number_users(rows))
    assert partials.count() > 3
    assert [tuple(r) for r in gold.merged_funding_totals(partials).collect()] == [(7, 100_000, 200_000)]


def test_a_reader_between_write_and_switch_sees_the_old_rows(spark, tmp_path):
    base, db = str(tmp_path), "switch_db"
    old, new = spark.range(3).toDF("a"), spark.range(10, 14).toDF("a")
    rows = lambda df: sorted(r.a for r in df.collect())
    sinks.publish_mart(old, base, "m", db)
    held = spark.table(f"{db}.m")
    held._jdf.queryExecution().executedPlan()
    sinks.publish_mart(new, base, "m", db)
    assert rows(held) == [0, 1, 2] and rows(spark.table(f"{db}.m")) == [10, 11, 12, 13]
    assert len(sinks.drop_old_versions(spark, base, "m", db)) == 1
    assert rows(spark.table(f"{db}.m")) == [10, 11, 12, 13]
    sinks.publish_mart(new.withColumn("b", F.lit(1)), base, "m", db)  # other columns
    assert spark.table(f"{db}.m").columns == ["a", "b"]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_one_day_is_switched_and_others_are_pruned(spark, tmp_path):
    base, db = str(tmp_path), "days_db"
    day = lambda n: spark.createDataFrame([(f"u{n}", n)], "user_id_hash string, campaign_id long")
    sinks.overwrite_partition(day(1), base, "wishes", "20240101")
    sinks.register_daily_table(spark, db, base, "wishes")
    for n in (2, 3):
        sinks.publish_day(day(n), base, "wishes", "20240102", db)
    read = spark.table(f"{db}.wishes").where("dt = '20240102'").select("user_id_hash")
    assert [r[0] for r in read.collect()] == ["u3"]
    assert "PartitionFilters: [isnotnull(dt" in read._jdf.queryExecution().executedPlan().toString()
    assert spark.table(f"{db}.wishes").count() == 2
    spark.sql(f"DROP DATABASE {db} CASCADE")
