"""Queries that go through the catalogue, the quarantine, and partials of a history.

The tables that they declare are known to the session that runs them only, as its catalogue may be in memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart import fixed_values as fv, sinks
from pledgemart.operators.partials import number_users
from pledgemart.operators import sketches
from pledgemart.operators.quality import ERROR_REASON, split_valid_and_error, validation_metrics
from pledgemart.plans import gold
from pledgemart.queries import marts, views
from pledgemart.queries.files import fresh_folder
from pledgemart.queries.views import with_views
from pledgemart.registry import get_schema
from pledgemart.sources.csv_marts import read_quoted_csv
from pledgemart.sources.ledger import update_day


def _database() -> str:
    return f"q{uuid.uuid4().hex}"


def switched_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart is rebuilt while a reader holds it: the reader sees the old rows, the next one the new rows."""
    base, db = fresh_folder(spark), _database()
    orders = views.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sinks.publish_mart(orders.where("o_custkey % 2 = 0"), base, "orders_kpi", db)
    reader = spark.table(f"{db}.orders_kpi").select(F.lit("held").alias("reader"), "*")
    reader._jdf.queryExecution().executedPlan()  # planned, as of a query that runs already
    sinks.publish_mart(orders.where("o_custkey % 2 = 1"), base, "orders_kpi", db)
    return reader.union(spark.table(f"{db}.orders_kpi").select(F.lit("next"), "*"))


_SWITCHED_SQL = "SELECT if(o_custkey % 2 = 0, 'held', 'next') AS reader, o_orderkey, o_custkey FROM orders"


def public_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign mart as a table, its public view declared, and read through the view."""
    base, db = fresh_folder(spark), _database()
    sinks.publish_mart(marts.campaign_kpi(spark, sf_dir), base, "campaign_kpi", db)
    (view,) = sinks.create_public_views(spark, db, ["campaign_kpi"])
    return spark.table(view)


def catalogue_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily table: two days registered, one found by repair, one replaced aside; read for some days only."""
    base, db = fresh_folder(spark), _database()
    wishes = views.wishes(spark, sf_dir).select("user_id_hash", F.col("campaign_id").try_cast("bigint").alias("campaign_id"), "snapshot_at")
    wishes = wishes.withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp_ntz")).where("campaign_id IS NOT NULL")
    day = lambda n: wishes.where(F.col("campaign_id") % 3 == n)
    for n in (0, 1):
        sinks.overwrite_partition(day(n), base, "wishes", f"2024010{n + 1}")
    sinks.register_daily_table(spark, db, base, "wishes")
    sinks.overwrite_partition(day(2).where("campaign_id % 2 = 0"), base, "wishes", "20240103")
    sinks.register_daily_table(spark, db, base, "wishes")
    sinks.publish_day(day(2), base, "wishes", "2024-01-03", db)
    return spark.table(f"{db}.wishes").where("dt >= '20240102'").select("user_id_hash", "campaign_id", "dt")


_DAYS_SQL = with_views(
    "SELECT user_id_hash, campaign_id, '2024010' || CAST(campaign_id % 3 + 1 AS VARCHAR) AS dt FROM ad_wishes WHERE campaign_id % 3 > 0",
    "ad_wishes",
)


def _with_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.wishes(spark, sf_dir).select("user_id_hash", F.col("campaign_id").try_cast("bigint").alias("campaign_id"), F.date_format("snapshot_at", "yyyyMMdd").alias("snapshot_dt"), F.date_format("snapshot_at", "yyyyMMdd").alias("wish_snapshot_date"), "dt")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key are set aside with the reason, as a day of their own, and read back."""
    base = fresh_folder(spark)
    _, errors = split_valid_and_error(_with_missing_keys(spark, sf_dir), get_schema("wishes"))
    path = sinks.overwrite_partition(errors, base, "wishes", "20240101")
    return views.configure(spark).read.parquet(path).select("user_id_hash", "campaign_id", F.col(ERROR_REASON).alias("reason"))


_QUARANTINE_SQL = with_views(
    "SELECT user_id_hash, campaign_id, 'missing_required_key' AS reason FROM ad_wishes WHERE campaign_id IS NULL", "ad_wishes"
)


def key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_missing_keys(spark, sf_dir)
    return rows.agg(*validation_metrics(rows, get_schema("wishes")))


_METRICS_SQL = with_views(
    "SELECT count(*) AS input_rows, count(campaign_id) AS valid_rows, count(*) - count(campaign_id) AS error_rows FROM ad_wishes", "ad_wishes"
)


def campaign_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of one campaign as an extract, read back as text."""
    path = f"{fresh_folder(spark)}/one"
    daily = marts.campaign_daily_kpi(spark, sf_dir).select("campaign_id", "dt", "title", "total_funding_amount", "participation_cnt")
    sinks.export_campaign(daily, "3", path)
    return read_quoted_csv(spark, path)


_EXTRACT_SQL = with_views(
    "SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, dt, title, CAST(total_funding_amount AS VARCHAR) AS total_funding_amount, "
    "CAST(participation_cnt AS VARCHAR) AS participation_cnt FROM campaign_daily_kpi WHERE campaign_id = 3", "campaign_daily_kpi",
)


def _years(df: DataFrame) -> DataFrame:
    """A year's rows as one delivery, to have few of them."""
    return df.withColumn("dt", F.substring("dt", 1, 4))


def _from_partials(spark: SparkSession, sf_dir: str, table, partials, merged) -> DataFrame:
    """The first years in one go, then the others as they come: users numbered on, their partials added, all merged."""
    base, rows = fresh_folder(spark), _years(table(spark, sf_dir))
    for n, some in enumerate((rows.where("dt < '1997'"), rows.where("dt >= '1997'"))):
        known = spark.read.parquet(f"{base}/users") if n else None
        number_users(some, known).write.mode("append").parquet(f"{base}/users")
        partials(some, spark.read.parquet(f"{base}/users")).write.mode("append").partitionBy("dt").parquet(f"{base}/partials")
    return merged(spark.read.parquet(f"{base}/partials"))


def supporter_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_partials(spark, sf_dir, views.supporter, gold.supporter_partials, gold.merged_supporter_totals)


def funding_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_partials(spark, sf_dir, views.fundings, gold.funding_partials, gold.merged_funding_totals)


def median_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order values per priority from sketches of the years, as they come; is the merged median near the middle?"""
    base, orders = fresh_folder(spark), views.read(spark, sf_dir, "orders")
    orders = orders.withColumn("dt", F.date_format("o_orderdate", "yyyy"))
    for some in (orders.where("dt < '1997'"), orders.where("dt >= '1997'")):
        sketches.day_sketches(some, ["dt", "o_orderpriority"], "o_totalprice").write.mode("append").partitionBy("dt").parquet(f"{base}/sketches")
    merged = sketches.merged_quantile(spark.read.parquet(f"{base}/sketches"), "o_orderpriority", "median")
    # As many rows as there are groups.
    ranked = orders.join(merged, "o_orderpriority").groupBy("o_orderpriority", "n").agg(
        F.avg((F.col("o_totalprice") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("o_totalprice") <= F.col("median")).cast("double")).alias("upto")
    )
    error = 2 * sketches.rank_error()
    return ranked.select("o_orderpriority", "n", ((F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)).alias("is_middle"))


def day_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day landed in two parts, the second to be read before the first, and in part of the same orders."""
    base, orders = fresh_folder(spark), views.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")

    def conform(records: DataFrame) -> DataFrame:
        read = lambda name, kind: F.try_variant_get("record", f"$.{name}", kind).alias(name)
        return records.select(read("o_orderkey", "bigint"), read("o_custkey", "bigint"), read("part", "string"), "read_order")

    held = ledger = None
    for n, (hour, kept) in enumerate((("05", "o_custkey % 3 < 2"), ("03", "o_custkey % 3 > 0"))):
        sinks.land_records(orders.where(kept).withColumn("part", F.lit(hour)), f"{base}/landed", "preorder", "20240101", hour=hour)
        day = update_day(spark, f"{base}/landed", "preorder", "20240101", ["o_orderkey"], conform, held, ledger)
        day.rows.write.parquet(f"{base}/rows{n}")
        held, ledger = spark.read.parquet(f"{base}/rows{n}"), day.ledger
    return held.drop("read_order")


QUERIES = {
    "ag_median_history": median_history,
    "src_day_in_parts": day_in_parts,
    "snk_switched_mart": switched_mart,
    "snk_public_view": public_view,
    "src_catalogue_days": catalogue_days,
    "snk_quarantine": quarantine,
    "ag_validation_metrics": key_metrics,
    "snk_campaign_extract": campaign_extract,
    "ag_supporter_history": supporter_history,
    "ag_funding_history": funding_history,
}
ORACLES = {
    "ag_median_history": "SELECT o_orderpriority, count(o_totalprice) AS n, true AS is_middle FROM orders GROUP BY o_orderpriority",
    "src_day_in_parts": "SELECT o_orderkey, o_custkey, if(o_custkey % 3 = 2, '03', '05') AS part FROM orders",
    "snk_switched_mart": _SWITCHED_SQL,
    "snk_public_view": with_views(f"SELECT {', '.join(fv.PUBLIC_CAMPAIGN_COLUMNS)} FROM campaign_kpi", "campaign_kpi"),
    "src_catalogue_days": _DAYS_SQL,
    "snk_quarantine": _QUARANTINE_SQL,
    "ag_validation_metrics": _METRICS_SQL,
    "snk_campaign_extract": _EXTRACT_SQL,
    "ag_supporter_history": with_views("SELECT * FROM supporter_sums", "supporter_sums"),
    "ag_funding_history": with_views(
        "SELECT campaign_id, count(DISTINCT user_id_hash) AS funding_user_cnt, CAST(sum(amount) AS BIGINT) AS user_history_funding_amount "
        "FROM ad_fundings GROUP BY campaign_id", "ad_fundings"),
}
