"""Queries that write given tables to a fresh shared folder and read them back through the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart import sinks
from pledgemart.plans import gold, present
from pledgemart.queries import marts, views
from pledgemart.queries.views import with_views
from pledgemart.sources import csv_marts, landing, shapes

DT = "20240101"


def fresh_folder(spark: SparkSession) -> str:
    """A new folder below the one the session shares, or below its warehouse if it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.read(spark, sf_dir, "orders")


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in two hours as JSON lines, the second day aside; read as records of one day."""
    base, orders = fresh_folder(spark), _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority")
    sinks.land_records(orders.where("o_orderkey % 2 = 0"), base, "preorder", DT, hour="03", rows_per_file=1000)
    sinks.land_records(orders.where("o_orderkey % 2 = 1"), base, "preorder", DT, hour="04")
    sinks.land_records(orders, base, "preorder", "2024-01-02")
    records = landing.read_records(spark, base, "preorder", "2024-01-01")
    read = lambda name, kind: F.try_variant_get("record", f"$.{name}", kind).alias(name)
    return records.select(
        read("o_orderkey", "bigint"), read("o_custkey", "bigint"), read("o_orderpriority", "string"),
        F.regexp_extract("source_key", "hour=([0-9]+)", 1).alias("hour"),
    )


_LANDED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderpriority, if(o_orderkey % 2 = 0, '03', '04') AS hour FROM orders"""


def shape_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed plain, with renamed fields, and in a wrapper with a nested part; what fields are there?"""
    base, orders = fresh_folder(spark), _orders(spark, sf_dir)
    nested = F.struct("o_orderkey", F.struct(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("state")).alias("customer"))
    deliveries = (
        ("o_orderkey", "o_custkey", "o_orderpriority"),
        (F.col("o_orderkey").alias("orderKey"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("o_custkey")),
        (F.array(nested).alias("data"), "o_orderkey"),
    )
    for n, columns in enumerate(deliveries):
        sinks.land_records(orders.where(F.col("o_orderkey") % 3 == n).select(*columns), base, "fundings", DT, hour=f"0{n + 3}")
    known = shapes.known_paths(["o_orderkey o_order_key", "o_custkey customer.key customer.id", "_parent_o_orderkey"])
    report = shapes.field_report(landing.read_records(spark, base, "fundings", DT), known)
    return report.drop("kind")


# Nulls are not landed, so a field that is there is filled.
_SHAPES_SQL = """
    WITH o AS (SELECT *, o_orderkey % 3 AS n FROM orders),
    fields AS (
      SELECT 'o_orderkey' AS field, 'known' AS status, count(o_orderkey) FILTER (n <> 1) AS records FROM o
      UNION ALL SELECT 'o_order_key', 'vanished', 0
      UNION ALL SELECT 'o_custkey', 'known', count(o_custkey) FILTER (n = 0 OR n = 1 AND o_custkey % 2 = 0) FROM o
      UNION ALL SELECT 'customer', 'known', count(*) FILTER (n = 2) FROM o
      UNION ALL SELECT 'customer.key', 'known', count(o_custkey) FILTER (n = 2) FROM o
      UNION ALL SELECT 'customer.id', 'vanished', 0
      UNION ALL SELECT 'customer.state', 'unknown', count(o_orderstatus) FILTER (n = 2) FROM o
      UNION ALL SELECT 'o_orderpriority', 'unknown', count(o_orderpriority) FILTER (n = 0) FROM o
      UNION ALL SELECT 'orderKey', 'unknown', count(o_orderkey) FILTER (n = 1) FROM o)
    SELECT field, status, records, records AS filled FROM fields"""


def replaced_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that is written twice holds the second rows only, the day beside it stays."""
    base, rows = fresh_folder(spark), _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    sinks.overwrite_partition(rows, base, "t", DT)
    sinks.overwrite_partition(rows.where("o_custkey % 3 = 0"), base, "t", "2024-01-02")
    sinks.overwrite_partition(rows.where("o_custkey % 3 = 1"), base, "t", "2024-01-01", sort_keys=["o_orderkey"])
    return views.configure(spark).read.parquet(f"{base}/t").select("o_orderkey", "o_custkey", "dt")


_REPLACED_SQL = """
    SELECT o_orderkey, o_custkey, if(o_custkey % 3 = 1, '20240101', '20240102') AS dt FROM orders WHERE o_custkey % 3 < 2"""


def csv_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of several parts, read back as text with its dates parsed."""
    base = fresh_folder(spark)
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("dt"),
        F.concat(F.lit('say "'), "o_orderpriority", F.lit('", then\nmore')).alias("note"),
        F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")).alias("customer"),
    )
    sinks.export_extract(rows.repartition(4, "o_orderkey"), f"{base}/orders_kpi.csv")
    back = csv_marts.read_csv_mart(spark, base, "orders_kpi")
    return back.select("o_orderkey", "dt", "note", F.nullif("customer", F.lit("")).alias("customer"))


_CSV_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dt,
      'say "' || o_orderpriority || '", then' || chr(10) || 'more' AS note,
      if(o_custkey % 5 > 0, CAST(o_custkey AS VARCHAR), NULL) AS customer
    FROM orders"""


def coerced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column nearly always of eight digits, one of dates with dashes."""
    day = F.col("o_orderdate")
    rows = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 20 > 0, F.date_format(day, "yyyyMMdd")).otherwise("soon").alias("dt"),
        F.date_format(day, "yyyy-MM-dd").alias("order_date"),
    )
    return csv_marts.coerce_dates(rows)


_COERCED_SQL = """
    SELECT o_orderkey, if(o_orderkey % 20 > 0, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), NULL) AS dt,
      CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date
    FROM orders"""


def one_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.campaign_daily_kpi(spark, sf_dir)
    return present.for_campaign({"daily": daily}, "3")["daily"]


def first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First text and first number, in the order of all columns; the first rows have none."""
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", F.when(F.col("o_orderkey") > 40, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderkey") > 50, F.col("o_custkey").cast("string")).otherwise("none").alias("Total_Amount"),
    )
    text = present.first_value(rows, ["missing", "priority"]).select(F.lit("text").alias("name"), "value")
    number = present.first_number(rows, ["total_amount"]).select(F.lit("number").alias("name"), F.col("value").cast("bigint").cast("string").alias("value"))
    return text.union(number)


_FIRST_SQL = """
    SELECT 'text' AS name, arg_min(o_orderpriority, o_orderkey) AS value FROM orders WHERE o_orderkey > 40
    UNION ALL SELECT 'number', CAST(arg_min(o_custkey, o_orderkey) AS VARCHAR) FROM orders WHERE o_orderkey > 50"""

_OTHER_MARTS = {
    "campaign_daily_kpi": marts.campaign_daily_kpi, "campaign_conversion_kpi": marts.campaign_conversion_kpi,
    "comment_nlp_kpi": marts.comment_nlp_kpi, "campaign_response_performance": marts.campaign_response_performance,
    "campaign_category_benchmark": marts.campaign_category_benchmark,
}


def _public(mart: str):
    return lambda spark, sf_dir: gold.public_view(mart, _OTHER_MARTS[mart](spark, sf_dir))


QUERIES = {
    "src_read_files": landed_records,
    "src_shape_report": shape_report,
    "snk_replace_day": replaced_day,
    "src_csv_mart": csv_mart,
    "p_date_coercion": coerced_dates,
    "p_one_campaign": one_campaign,
    "p_first_values": first_values,
    **{f"m7_public_{mart}": _public(mart) for mart in _OTHER_MARTS},
}
ORACLES = {
    "src_read_files": _LANDED_SQL,
    "src_shape_report": _SHAPES_SQL,
    "snk_replace_day": _REPLACED_SQL,
    "src_csv_mart": _CSV_SQL,
    "p_date_coercion": _COERCED_SQL,
    "p_one_campaign": with_views("SELECT * FROM campaign_daily_kpi WHERE campaign_id = 3", "campaign_daily_kpi"),
    "p_first_values": _FIRST_SQL,
    **{f"m7_public_{mart}": with_views(f"SELECT * FROM {mart}", mart) for mart in _OTHER_MARTS},
}
