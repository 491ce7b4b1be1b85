"""Plan shapes that have to hold at scale, and skewed inputs."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pledgemart.operators.dedup import first_per_group, keep_last
from pledgemart.operators.median import exact_median, middle_values
from pledgemart.plans import gold, present

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES = {name: query for module in entry.MODULES for name, query in module.QUERIES.items()}


def windows_without_keys(plan):
    """Window definitions whose first part is an order or a frame: they have no partition key."""
    firsts = re.findall(r"windowspecdefinition\(([^,)]*)", plan)
    return [x for x in firsts if re.search(r" (ASC|DESC) |specifiedwindowframe", x)]


def test_windows_without_keys_are_found(spark):
    one = spark.range(5).select(F.expr("row_number() OVER (ORDER BY id)"))
    other = spark.range(5).select(F.expr("row_number() OVER (PARTITION BY id % 2 ORDER BY id)"))
    assert windows_without_keys(plan_of(one)) and not windows_without_keys(plan_of(other))


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_single_task_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not windows_without_keys(plan)


def test_median_of_values_with_a_far_outlier_ranks_few_of_them(spark):
    rows = spark.range(20001).select(F.lit("c").alias("k"), F.when(F.col("id") < 20000, F.col("id")).otherwise(10**12).alias("v"))
    assert exact_median(rows, "k", "v", "m").first().m == 10000.0
    assert middle_values(rows, "k", "v").count() < 400


def test_campaign_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "campaign_id").write.parquet(f"{tmp_path}/m")
    cut = present.for_campaign({"m": spark.read.parquet(f"{tmp_path}/m")}, "7")["m"]
    assert "EqualTo(campaign_id,7)" in plan_of(cut) and [r.campaign_id for r in cut.collect()] == [7]


def test_rows_that_tie_are_settled_by_their_columns(spark):
    for order in ("id", "-id"):
        rows = spark.range(50).selectExpr("id % 2 k", "1 t", "id v").orderBy(F.expr(order)).repartition(5)
        assert sorted(tuple(r) for r in first_per_group(rows, ["k"], [F.desc("t")]).collect()) == [(0, 1, 0), (1, 1, 1)]


def test_dedup_cuts_groups_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("read_order"))
    lines = plan_of(keep_last(df, ["k"])).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert exchange < partial


def test_supporter_totals_need_no_expand(spark):
    df = spark.createDataFrame(
        [], "campaign_id bigint, user_id_hash string, is_purchaser boolean, is_signer boolean, backing_amount bigint, dt string")
    assert "Expand" not in plan_of(gold.supporter_totals(df))


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(gold.wish_totals(spark.read.parquet(f"{SF_DIR}/events.parquet").select(
        F.col("user_id").cast("string").alias("user_id_hash"), F.col("event_id").alias("campaign_id"), "value", "props")))
    assert "props" not in plan.split("ReadSchema:")[1].splitlines()[0]
    assert "IsNotNull(event_id)" in plan


@pytest.fixture
def hot(spark):
    """90,000 rows, a third of them of one campaign and user."""
    return spark.range(90000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("campaign_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("user_id_hash"),
        (F.col("id") % 2 == 0).alias("is_purchaser"), (F.col("id") % 5 == 0).alias("is_signer"),
        (F.col("id") % 100).alias("backing_amount"), F.col("id").alias("read_order"), F.lit("20260510").alias("dt"))


def test_hot_campaign_totals(hot):
    got = {r.campaign_id: r for r in gold.supporter_totals(hot).collect()}
    plain = hot.groupBy("campaign_id").agg(
        F.count_distinct("user_id_hash").alias("supporter_user_cnt"),
        F.count_distinct(F.when(F.col("is_purchaser"), F.col("user_id_hash"))).alias("purchaser_cnt"),
        F.count_distinct(F.when(F.col("is_signer"), F.col("user_id_hash"))).alias("signer_user_cnt"),
        F.sum(F.when(F.col("is_purchaser"), F.col("backing_amount")).otherwise(0)).alias("supporter_backing_amount"),
        F.avg(F.when(F.col("is_purchaser"), F.col("backing_amount").cast("double"))).alias("avg_supporter_backing_amount"))
    want = {r.campaign_id: r for r in plain.collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key].asDict() == row.asDict()


def test_hot_key_dedup(hot):
    kept = {r.user_id_hash: r.read_order for r in keep_last(hot, ["user_id_hash"]).collect()}
    want = {r.user_id_hash: r.m for r in hot.groupBy("user_id_hash").agg(F.max("read_order").alias("m")).collect()}
    assert kept == want


def test_hot_category_median(hot):
    got = {r.campaign_id: r.m for r in exact_median(hot, "campaign_id", "read_order", "m").collect()}
    want = {r.campaign_id: r.m for r in hot.groupBy("campaign_id").agg(F.percentile("read_order", 0.5).alias("m")).collect()}
    assert got == want


def test_hot_vocabulary(spark):
    words = spark.range(20000).select(
        F.floor(F.col("id") / 20000).alias("campaign_id"),
        F.when(F.col("id") >= 0, "positive").alias("sentiment"),
        F.concat(F.lit("w"), F.col("id")).alias("word"), (F.col("id") % 1000 + 1).alias("count"))
    cloud = present.word_cloud(words)
    assert cloud.count() == 28 and cloud.agg(F.min("count")).first()[0] == 999
    plan = plan_of(cloud)
    assert plan.count("WindowGroupLimit") == 2
