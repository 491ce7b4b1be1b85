"""The given tables seen as daily tables, once as DataFrames and once as SQL.

Money and rates are cut to whole units, so that sums are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pledgemart.functions import classify, pii, text as nlp
from pledgemart.session import configure

SALT = "s"
TARGET_AMOUNT = 1000000
LEXICON = nlp.Lexicon(
    positive=["the ", "ation"],
    negative=["ing", "ent"],
    groups={"question": ["que"], "delivery": ["der"], "usage": ["tion"]},
    lower=True,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def whole(value) -> F.Column:
    return F.floor(value).cast("bigint")


def user_hash(user_id) -> F.Column:
    return pii.salted_hash(user_id, SALT)


def preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per supplier and ship day, with running totals; several snapshots share a ``dt``."""
    daily = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(
            F.sum(whole(F.col("l_extendedprice"))).alias("amount"),
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    so_far = Window.partitionBy("l_suppkey").orderBy("l_shipdate").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(
        "l_suppkey",
        "l_shipdate",
        F.sum("amount").over(so_far).alias("total"),
        F.sum("lines").over(so_far).alias("participation_cnt"),
        F.sum("returned").over(so_far).alias("signature_cnt"),
    )
    supplier = read(spark, sf_dir, "supplier").join(
        read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("l_suppkey")
    return running.join(supplier, key == F.col("s_suppkey")).select(
        key.alias("campaign_id"),
        key.alias("maker_id"),
        F.col("s_name").alias("maker_name"),
        F.col("s_name").alias("corp_name"),
        F.col("s_name").alias("title"),
        F.col("n_name").alias("category_code"),
        F.col("n_name").alias("category_name"),
        F.lit("").alias("core_message"),
        (F.col("l_shipdate") - F.expr("INTERVAL 7 DAYS")).alias("open_ts"),
        (F.col("l_shipdate") + F.expr("INTERVAL 7 DAYS")).alias("close_ts"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("snapshot_dt"),
        F.col("l_shipdate").alias("snapshot_ts"),
        (key % 7 - 3).alias("remaining_day"),
        F.floor(F.col("total") * 100 / TARGET_AMOUNT).cast("double").alias("achievement_rate"),
        (F.col("total").cast("double") / TARGET_AMOUNT).alias("funding_ratio"),
        F.lit(TARGET_AMOUNT).cast("bigint").alias("target_amount"),
        F.col("total").alias("total_funding_amount"),
        "participation_cnt",
        "signature_cnt",
        F.when(key % 2 == 0, "open").otherwise("closed").alias("status_simplified"),
        F.when(key % 2 == 0, "preorder").otherwise("funding").alias("biz_model"),
        (key % 2 == 0).alias("has_coupon"),
        F.concat(F.lit("G"), (key % 3).cast("string")).alias("maker_club_grade"),
        (key % 3 == 0).alias("is_delivery_available"),
        (key % 5 == 0).alias("is_global_shipping_available"),
        F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("01")).alias("dt"),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Hashed after the join: its shuffle and sort hold a number per order instead of 64 letters.
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("user_id_hash", user_hash(F.col("o_custkey")))


def supporter(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "signature").when(flag == "A", "purchase").otherwise("view")
    amount = F.when(flag == "A", whole(F.col("l_extendedprice"))).otherwise(F.lit(0).cast("bigint"))
    return _order_lines(spark, sf_dir).select(
        "user_id_hash",
        F.col("l_suppkey").alias("campaign_id"),
        kind.alias("supporter_type"),
        amount.alias("backing_amount"),
        F.col("l_shipdate").alias("participated_at"),
        classify.is_purchaser(kind, amount.cast("string")).alias("is_purchaser"),
        classify.is_signer(kind).alias("is_signer"),
        F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("01")).alias("dt"),
    )


def fundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        "user_id_hash",
        F.col("l_suppkey").alias("campaign_id"),
        whole(F.col("l_extendedprice")).alias("amount"),
        F.col("l_shipdate").alias("funded_at"),
        F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("01")).alias("dt"),
    )


def wishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; some have a campaign id that is no number, some have none."""
    number = F.get_json_object("props", "$.k")
    campaign = F.when(F.col("event_id") % 50 == 0, F.lit("no id")).when(F.col("event_id") % 50 != 1, number)
    return read(spark, sf_dir, "events").select(
        user_hash(F.col("user_id")).alias("user_id_hash"),
        campaign.alias("campaign_id"),
        F.col("ts").alias("snapshot_at"),
        (whole(F.col("value")) % 5 - 2).alias("remaining_day_at_wish_snapshot"),
        F.date_format("ts", "yyyyMMdd").alias("dt"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    # The next turn by an equi-join, so a very long conversation stays spread out.
    answers = turns.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("a_conv"), (F.col("turn") - 1).alias("a_turn")
    )
    joined = turns.join(
        answers, (F.col("conv_id") == F.col("a_conv")) & (F.col("turn") == F.col("a_turn")), "left"
    )
    turn, answered = F.col("turn"), F.col("a_turn").isNotNull()
    balance = nlp.sentiment_balance(F.col("text"), LEXICON)
    return joined.select(
        (F.col("conv_id") * 100 + turn).cast("string").alias("comment_id"),
        (F.col("conv_id") % 100).alias("campaign_id"),
        F.when(turn == 0, 0).otherwise(1).cast("bigint").alias("depth"),
        F.when(turn > 0, (F.col("conv_id") * 100).cast("string")).alias("parent_comment_id"),
        F.col("text").alias("comment_body_cleaned"),
        answered.alias("is_answered"),
        F.when(answered, turn.cast("double") * 1.5).alias("time_to_first_answer_min"),
        nlp.keyword_groups(F.col("text"), LEXICON).alias("keyword_groups"),
        nlp.sentiment_score(balance).alias("sentiment_score"),
        nlp.sentiment_label(balance).alias("sentiment_label"),
        nlp.is_question(F.col("text")).alias("contains_question_mark"),
        (F.col("role") == "assistant").alias("is_maker"),
        F.lit(False).alias("is_owner"),
        F.concat(F.lit("202401"), F.lpad((turn + 1).cast("string"), 2, "0")).alias("dt"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    customer = read(spark, sf_dir, "customer")
    return customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        user_hash(F.col("c_custkey")).alias("user_id_hash"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("total_funding_count"),
        (F.col("c_custkey") % 5).alias("signature_count"),
        (F.col("c_custkey") % 4).alias("interest_count"),
    )


# name -> (names it builds on, SQL)
VIEW_SQL: dict[str, tuple[list[str], str]] = {
    "ad_preorder": ([], f"""
        SELECT r.l_suppkey AS campaign_id, r.l_suppkey AS maker_id, s.s_name AS maker_name, s.s_name AS corp_name,
          s.s_name AS title, n.n_name AS category_code, n.n_name AS category_name, '' AS core_message,
          r.l_shipdate - INTERVAL 7 DAY AS open_ts, r.l_shipdate + INTERVAL 7 DAY AS close_ts,
          strftime(r.l_shipdate, '%Y%m%d') AS snapshot_dt, r.l_shipdate AS snapshot_ts,
          r.l_suppkey % 7 - 3 AS remaining_day,
          floor(CAST(r.total * 100 AS DOUBLE) / CAST({TARGET_AMOUNT} AS DOUBLE)) AS achievement_rate,
          CAST(r.total AS DOUBLE) / CAST({TARGET_AMOUNT} AS DOUBLE) AS funding_ratio,
          CAST({TARGET_AMOUNT} AS BIGINT) AS target_amount, r.total AS total_funding_amount,
          r.participation_cnt, r.signature_cnt,
          CASE WHEN r.l_suppkey % 2 = 0 THEN 'open' ELSE 'closed' END AS status_simplified,
          CASE WHEN r.l_suppkey % 2 = 0 THEN 'preorder' ELSE 'funding' END AS biz_model,
          r.l_suppkey % 2 = 0 AS has_coupon, 'G' || CAST(r.l_suppkey % 3 AS VARCHAR) AS maker_club_grade,
          r.l_suppkey % 3 = 0 AS is_delivery_available, r.l_suppkey % 5 = 0 AS is_global_shipping_available,
          strftime(r.l_shipdate, '%Y%m') || '01' AS dt
        FROM (
          SELECT l_suppkey, l_shipdate,
            CAST(SUM(amount) OVER w AS BIGINT) AS total,
            CAST(SUM(lines) OVER w AS BIGINT) AS participation_cnt,
            CAST(SUM(returned) OVER w AS BIGINT) AS signature_cnt
          FROM (
            SELECT l_suppkey, l_shipdate, SUM(CAST(floor(l_extendedprice) AS BIGINT)) AS amount,
              COUNT(*) AS lines, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
            FROM lineitem GROUP BY l_suppkey, l_shipdate
          )
          WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS UNBOUNDED PRECEDING)
        ) r JOIN supplier s ON r.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "ad_supporter": ([], """
        SELECT sha256('s:' || CAST(o_custkey AS VARCHAR)) AS user_id_hash, l_suppkey AS campaign_id,
          CASE l_returnflag WHEN 'R' THEN 'signature' WHEN 'A' THEN 'purchase' ELSE 'view' END AS supporter_type,
          CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE 0 END AS backing_amount,
          l_shipdate AS participated_at, l_returnflag = 'A' AS is_purchaser, l_returnflag = 'R' AS is_signer,
          strftime(l_shipdate, '%Y%m') || '01' AS dt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "ad_fundings": ([], """
        SELECT sha256('s:' || CAST(o_custkey AS VARCHAR)) AS user_id_hash, l_suppkey AS campaign_id,
          CAST(floor(l_extendedprice) AS BIGINT) AS amount, l_shipdate AS funded_at,
          strftime(l_shipdate, '%Y%m') || '01' AS dt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "ad_wishes": ([], r"""
        SELECT sha256('s:' || CAST(user_id AS VARCHAR)) AS user_id_hash,
          if(event_id % 50 > 1, CAST(regexp_extract(props, '"k": *(\d+)', 1) AS BIGINT), NULL) AS campaign_id, ts AS snapshot_at,
          CAST(floor(value) AS BIGINT) % 5 - 2 AS remaining_day_at_wish_snapshot, strftime(ts, '%Y%m%d') AS dt
        FROM events"""),
    "ad_comments": ([], """
        SELECT CAST(t.conv_id * 100 + t.turn AS VARCHAR) AS comment_id, t.conv_id % 100 AS campaign_id,
          CAST(CASE WHEN t.turn = 0 THEN 0 ELSE 1 END AS BIGINT) AS depth,
          CASE WHEN t.turn > 0 THEN CAST(t.conv_id * 100 AS VARCHAR) END AS parent_comment_id,
          t.text AS comment_body_cleaned, a.turn IS NOT NULL AS is_answered,
          CASE WHEN a.turn IS NOT NULL THEN CAST(t.turn AS DOUBLE) * CAST(1.5 AS DOUBLE) END AS time_to_first_answer_min,
          concat_ws(',', CASE WHEN contains(lower(t.text), 'que') THEN 'question' END,
                         CASE WHEN contains(lower(t.text), 'der') THEN 'delivery' END,
                         CASE WHEN contains(lower(t.text), 'tion') THEN 'usage' END) AS keyword_groups,
          CAST(sign(t.balance) AS BIGINT) AS sentiment_score,
          CASE WHEN t.balance > 0 THEN 'positive' WHEN t.balance < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
          regexp_matches(t.text, '[?？]|나요|까요|문의') AS contains_question_mark,
          t.role = 'assistant' AS is_maker, false AS is_owner,
          '202401' || lpad(CAST(t.turn + 1 AS VARCHAR), 2, '0') AS dt
        FROM (SELECT *, contains(lower(text), 'the ')::INT + contains(lower(text), 'ation')::INT
                - contains(lower(text), 'ing')::INT - contains(lower(text), 'ent')::INT AS balance
              FROM conversations) t
        LEFT JOIN conversations a ON a.conv_id = t.conv_id AND a.turn = t.turn + 1 AND a.role = 'assistant'"""),
    "ad_user_info": ([], """
        SELECT sha256('s:' || CAST(c_custkey AS VARCHAR)) AS user_id_hash,
          COALESCE(o.orders, 0) AS total_funding_count, c_custkey % 5 AS signature_count,
          c_custkey % 4 AS interest_count
        FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey) o
          ON c_custkey = o.o_custkey"""),
}


def with_views(select: str, *names: str) -> str:
    """SQL with the named views, and what they build on, as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in VIEW_SQL[name][0]:
                visit(other)
            ordered.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({VIEW_SQL[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{select}"
