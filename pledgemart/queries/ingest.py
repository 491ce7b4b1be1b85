"""Landed-file handling and the table transforms, on JSON written from the given tables.

Each query writes documents in the shapes the crawlers land, one or more per row of a given
table, and reads them back through the library; the SQL states the outcome relationally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart.operators.quality import quality_metrics, with_error_reason
from pledgemart.plans import silver
from pledgemart.queries.views import LEXICON, SALT, read, whole
from pledgemart.registry import get_schema
from pledgemart.sources import landing, seeds

DT = "20260510"
SETTINGS = silver.Settings(hash_salt=SALT, lexicon=LEXICON)


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def _key(prefix: str, number: F.Column, hour: int = 3) -> F.Column:
    padded = F.lpad(number.cast("string"), 12, "0")
    return F.concat(F.lit(f"landing/{prefix}/dt={DT}/hour={hour:02d}/part_"), padded, F.lit(".json"))


def _records(files: DataFrame, table: str) -> DataFrame:
    return landing.records_of_table(landing.parse_documents(landing.with_file_position(files)), table)


def _iso(ts: F.Column) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _funding_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order with ``o_orderkey % 4`` items: a wrapper, a list of it, or lines with a bad one."""
    key = F.col("o_orderkey")
    item = lambda i: F.struct(
        ((key + i) % 1000).alias("projectId"),
        (whole(F.col("o_totalprice")) + i).cast("string").alias("amount"),
        F.when(key % 3 == 0, "REWARD").when(key % 3 == 1, "Store").alias("productType"),
        F.when(key % 5 < 3, (key % 2).cast("string")).alias("endYn"),
        (key % 9 - 4).alias("remainingDay"),
    )
    count = (key % 4).cast("int")
    items = F.slice(F.transform(F.sequence(F.lit(1), F.lit(3)), item), 1, count)
    wrapper = F.to_json(
        F.struct(
            F.when(key % 7 > 0, _iso(F.col("o_orderdate"))).alias("collected_at"),
            F.col("o_custkey").alias("user_id"),
            items.alias("data"),
        )
    )
    text = (
        F.when(key % 3 == 0, wrapper)
        .when(key % 3 == 1, F.concat(F.lit("["), wrapper, F.lit("]")))
        .otherwise(F.concat(F.lit("{broken\n"), wrapper, F.lit("\n\n")))
    )
    return read(spark, sf_dir, "orders").select(text.alias("text"), _key("fundings", key).alias("source_key"))


def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_funding_files(spark, sf_dir), "fundings")
    return records.select(
        F.try_element_at("parent", F.lit("user_id")).cast("bigint").alias("parent_user_id"),
        F.try_element_at("parent", F.lit("collected_at")).alias("parent_collected_at"),
        F.try_variant_get("record", "$.projectId", "bigint").alias("project_id"),
        F.try_variant_get("record", "$.amount", "bigint").alias("amount"),
        F.col("read_order.unit").cast("bigint").alias("line"),
        F.col("read_order.child_no").cast("bigint").alias("child"),
    )


_FUNDING_ITEMS = """
    SELECT o_orderkey AS k, i, o_custkey, o_orderdate, (o_orderkey + i) % 1000 AS campaign_id,
      CAST(floor(o_totalprice) AS BIGINT) + i AS amount,
      CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate + INTERVAL 9 HOUR ELSE NULL END AS collected
    FROM orders, generate_series(1, 3) g(i) WHERE i <= o_orderkey % 4"""
_ENVELOPE_SQL = f"""
    SELECT o_custkey AS parent_user_id,
      CASE WHEN k % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') END AS parent_collected_at,
      campaign_id AS project_id, amount, CAST(CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS BIGINT) AS line,
      CAST(i - 1 AS BIGINT) AS child
    FROM ({_FUNDING_ITEMS})"""


def _without_run_time(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at")


def fundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_funding_files(spark, sf_dir), "fundings")
    return _without_run_time(silver.build_table(records, "fundings", DT, SETTINGS))


_FUNDINGS_SQL = f"""
    SELECT sha256('s:' || CAST(o_custkey AS VARCHAR)) AS user_id_hash, campaign_id,
      CASE WHEN k % 3 = 1 THEN 'store' ELSE 'funding' END AS action_type, amount, funded_at,
      strftime(funded_at, '%Y%m%d') AS funded_date, CAST(hour(funded_at) AS BIGINT) AS funded_hour,
      CAST(isodow(funded_at) - 1 AS BIGINT) AS funded_dow,
      CASE WHEN amount <= 0 THEN 'unknown' WHEN amount < 30000 THEN 'under_30k' WHEN amount < 100000 THEN '30k_100k'
           WHEN amount < 300000 THEN '100k_300k' ELSE 'over_300k' END AS amount_tier,
      '' AS campaign_title, CASE k % 3 WHEN 0 THEN 'REWARD' WHEN 1 THEN 'Store' END AS product_type,
      k % 9 - 4 AS remaining_day_at_snapshot, CAST(NULL AS DOUBLE) AS achievement_rate_at_snapshot, '{DT}' AS dt
    FROM (SELECT *, COALESCE(collected, TIMESTAMP '2026-05-10 00:00:00') AS funded_at FROM ({_FUNDING_ITEMS}))
    QUALIFY row_number() OVER (PARTITION BY o_custkey, campaign_id, funded_at, amount ORDER BY k DESC, i DESC) = 1"""


def wishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_funding_files(spark, sf_dir), "fundings")
    return _without_run_time(silver.build_table(records, "wishes", DT, SETTINGS))


_WISHES_SQL = f"""
    SELECT sha256('s:' || CAST(o_custkey AS VARCHAR)) AS user_id_hash, campaign_id, snapshot_at,
      strftime(snapshot_at, '%Y%m%d') AS snapshot_dt, strftime(snapshot_at, '%Y%m%d') AS wish_snapshot_date,
      '' AS campaign_title, '' AS maker_name, CAST(NULL AS DOUBLE) AS achievement_rate_at_wish_snapshot,
      k % 9 - 4 AS remaining_day_at_wish_snapshot, amount AS amount_at_wish_snapshot,
      CASE k % 3 WHEN 0 THEN 'REWARD' WHEN 1 THEN 'Store' END AS product_type,
      CASE WHEN k % 5 < 3 THEN k % 2 = 0 ELSE k % 9 - 4 >= 0 END AS is_active_at_snapshot, '{DT}' AS dt
    FROM (SELECT *, COALESCE(collected, TIMESTAMP '2026-05-10 00:00:00') AS snapshot_at FROM ({_FUNDING_ITEMS}))
    QUALIFY row_number() OVER (PARTITION BY o_custkey, campaign_id, strftime(snapshot_at, '%Y%m%d')
                               ORDER BY k DESC, i DESC) = 1"""


# Puts the order dates, as epoch millis, into the 13-digit range.
_BILLION_SECONDS = 1000000000


def _preorder_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list of one item per order; half in camelCase with texts, half in lower case with numbers."""
    key = F.col("o_orderkey")
    camel = _json(
        campaignId=F.col("o_custkey"),
        title=F.col("o_orderpriority"),
        categoryCode=F.when(key % 4 == 0, "TECH").otherwise("misc"),
        status=F.lit(" OPEN "),
        collectedAt=_iso(F.col("o_orderdate")),
        remainingDay=F.lit("abc"),
        totalBackedAmount=F.concat(whole(F.col("o_totalprice")).cast("string"), F.lit(".0")),
        achievementRate=F.lit("12.5"),
        hasCoupon=F.lit("Y"),
        productType=F.lit("PREORDER"),
    )
    lower = _json(
        campaignid=F.col("o_custkey").cast("string"),
        makerid=key,
        userid=key,
        category_name=F.lit(""),
        collectedAt=F.unix_millis(F.col("o_orderdate").cast("timestamp")) + _BILLION_SECONDS * 1000,
        totalbackedamount=whole(F.col("o_totalprice")),
        participationcnt=F.lit(1.5),
        hascoupon=F.lit(False),
        producttype=F.lit("new"),
    )
    text = F.concat(F.lit("["), F.when(key % 2 == 0, camel).otherwise(lower), F.lit("]"))
    return read(spark, sf_dir, "orders").select(text.alias("text"), _key("preorder", key, 20).alias("source_key"))


def preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_preorder_files(spark, sf_dir), "preorder")
    return _without_run_time(silver.build_table(records, "preorder", DT, SETTINGS))


_PREORDER_SQL = f"""
    SELECT o_custkey AS campaign_id, CASE WHEN c THEN NULL ELSE o_orderkey END AS maker_id, '' AS maker_name,
      '' AS corp_name, CASE WHEN c THEN o_orderpriority ELSE '' END AS title,
      CASE WHEN c AND o_orderkey % 4 = 0 THEN 'TECH' WHEN c THEN 'misc' END AS category_code,
      CASE WHEN c AND o_orderkey % 4 = 0 THEN '테크/가전' WHEN c THEN 'misc' ELSE '' END AS category_name,
      '' AS core_message, CAST(NULL AS TIMESTAMP) AS open_ts, CAST(NULL AS TIMESTAMP) AS close_ts,
      strftime(collected + INTERVAL 9 HOUR, '%Y%m%d') AS snapshot_dt,
      collected + INTERVAL 9 HOUR AS snapshot_ts,
      CASE WHEN c THEN NULL ELSE CAST(0 AS BIGINT) END AS remaining_day,
      CASE WHEN c THEN NULL ELSE CAST(0 AS BIGINT) END AS remaining_days_at_snapshot,
      CASE WHEN c THEN CAST(12.5 AS DOUBLE) END AS achievement_rate, CAST(NULL AS DOUBLE) AS funding_ratio,
      CAST(0 AS BIGINT) AS target_amount, CAST(floor(o_totalprice) AS BIGINT) AS total_funding_amount,
      CASE WHEN c THEN CAST(0 AS BIGINT) END AS participation_cnt, CAST(0 AS BIGINT) AS signature_cnt,
      CASE WHEN c THEN '진행중' ELSE '' END AS status_simplified,
      CASE WHEN c THEN '예약구매' ELSE 'new' END AS biz_model,
      false AS is_adult, c AS has_coupon, CAST(NULL AS VARCHAR) AS maker_club_grade,
      false AS is_delivery_available, false AS is_global_shipping_available,
      CAST(NULL AS VARCHAR) AS thumbnail_url, '{DT}' AS dt
    FROM (SELECT *, o_orderkey % 2 = 0 AS c, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate
            ELSE o_orderdate + INTERVAL {_BILLION_SECONDS} SECOND END AS collected FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey, collected ORDER BY o_orderkey DESC) = 1"""


def _comment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per turn; two turns share a ``boardId`` and the later one has to win."""
    conv, turn = F.col("conv_id"), F.col("turn")
    raw = F.struct(
        (conv * 100 + F.floor(turn / 2)).alias("boardId"),
        F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>\t ok?")).alias("body"),
        F.lit("2026-05-10T20:30:00Z").alias("whenCreated"),
        conv.alias("encUserId"),
        (turn % 2 == 0).alias("hasReply"),
        (F.col("role") == "assistant").alias("maker"),
        F.when(turn > 0, conv * 100).alias("parentBoardId"),
    )
    text = _json(campaign_id=conv % 100, raw=raw, depth=F.least(turn, F.lit(1)), status=F.lit("success"))
    key = conv * 100 + turn
    return read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("["), text, F.lit("]")).alias("text"), _key("comments", key).alias("source_key")
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_comment_files(spark, sf_dir), "comments")
    return _without_run_time(silver.build_table(records, "comments", DT, SETTINGS))


_COMMENTS_SQL = rf"""
    SELECT CAST(conv_id * 100 + turn // 2 AS VARCHAR) AS comment_id, conv_id % 100 AS campaign_id,
      CAST(NULL AS VARCHAR) AS comment_type, least(turn, 1) AS depth,
      sha256('s:' || CAST(conv_id AS VARCHAR)) AS author_id_hash,
      TIMESTAMP '2026-05-11 05:30:00' AS comment_ts, '20260511' AS comment_date,
      length(body) AS content_length, body AS comment_body_cleaned,
      CASE WHEN turn > 0 THEN CAST(conv_id * 100 AS VARCHAR) END AS parent_comment_id,
      turn % 2 = 0 AS is_answered, CAST(NULL AS DOUBLE) AS time_to_first_answer_min,
      concat_ws(',', CASE WHEN contains(lower(body), 'que') THEN 'question' END,
                     CASE WHEN contains(lower(body), 'der') THEN 'delivery' END,
                     CASE WHEN contains(lower(body), 'tion') THEN 'usage' END) AS keyword_groups,
      CAST(sign(balance) AS BIGINT) AS sentiment_score,
      CASE WHEN balance > 0 THEN 'positive' WHEN balance < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
      true AS contains_question_mark, role = 'assistant' AS is_maker, false AS is_owner, false AS is_supporter,
      '{DT}' AS dt
    FROM (SELECT *, contains(lower(body), 'the ')::INT + contains(lower(body), 'ation')::INT
            - contains(lower(body), 'ing')::INT - contains(lower(body), 'ent')::INT AS balance
          FROM (SELECT *, trim(regexp_replace(
                  regexp_replace('<p>' || text || '</p>' || chr(9) || ' ok?', '<[^>]+>', ' ', 'g'),
                  '\s+', ' ', 'g')) AS body FROM conversations))
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn DESC) = 1"""


def _supporter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per order; the container alternates, amounts and types are often missing."""
    key = F.col("o_orderkey")
    inner = F.struct(
        F.when(key % 10 > 0, F.col("o_custkey").cast("string")).alias("encUserId"),
        F.when(key % 4 == 0, whole(F.col("o_totalprice"))).alias("backedAmount"),
        F.when(key % 3 == 0, "PREORDER").when(key % 3 == 1, "SIGNATURE").alias("type"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("whenCreated"),
        F.lit("no").alias("dontShowAmount"),
    )
    text = F.when(
        key % 2 == 0, F.to_json(F.struct((key % 97).alias("campaign_id"), inner.alias("raw_text")))
    ).otherwise(F.to_json(F.struct((key % 97).alias("commonId"), inner.alias("raw"))))
    return read(spark, sf_dir, "orders").select(text.alias("text"), _key("supporter", key).alias("source_key"))


def supporter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_supporter_files(spark, sf_dir), "supporter")
    return _without_run_time(silver.build_table(records, "supporter", DT, SETTINGS))


_SUPPORTER_ROWS = f"""
    SELECT CASE WHEN k % 10 > 0 THEN sha256('s:' || CAST(o_custkey AS VARCHAR)) END AS user_id_hash,
      k % 97 AS campaign_id, kind AS supporter_type, COALESCE(paid, 0) AS backing_amount,
      o_orderdate + INTERVAL 9 HOUR AS participated_at,
      strftime(o_orderdate + INTERVAL 9 HOUR, '%Y%m%d') AS participated_date,
      COALESCE(kind, '') = 'PREORDER' OR COALESCE(paid, 0) > 0 AS is_purchaser,
      COALESCE(kind, '') = 'SIGNATURE' AS is_signer, kind AS raw_support_type, false AS dont_show_amount,
      false AS is_active_user, false AS has_membership, '{DT}' AS dt, k
    FROM (SELECT o_orderkey AS k, o_custkey, o_orderdate,
            CASE WHEN o_orderkey % 4 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS paid,
            CASE o_orderkey % 3 WHEN 0 THEN 'PREORDER' WHEN 1 THEN 'SIGNATURE' END AS kind FROM orders)"""
_SUPPORTER_SQL = f"""
    SELECT * EXCLUDE (k) FROM ({_SUPPORTER_ROWS})
    QUALIFY row_number() OVER (PARTITION BY user_id_hash, campaign_id, participated_at, supporter_type
                               ORDER BY k DESC) = 1"""


def valid_error_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supporter rows by outcome: users whose id was missing go to the error side."""
    schema = get_schema("supporter")
    table = silver.build_table(_records(_supporter_files(spark, sf_dir), "supporter"), "supporter", DT, SETTINGS)
    return with_error_reason(table, schema).groupBy("campaign_id", "_silver_error_reason").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.sum("backing_amount").alias("amount")
    )


_SPLIT_SQL = f"""
    SELECT campaign_id, CASE WHEN user_id_hash IS NULL THEN 'missing_required_key' END AS _silver_error_reason,
      COUNT(*) AS row_cnt, CAST(SUM(backing_amount) AS BIGINT) AS amount
    FROM ({_SUPPORTER_SQL}) GROUP BY 1, 2"""


def table_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_supporter_files(spark, sf_dir), "supporter")
    conformed = silver.supporter(records, DT, SETTINGS)
    return quality_metrics(conformed, get_schema("supporter")).drop("null_silver_processed_at")


_QUALITY_SQL = f"""
    SELECT COUNT(*) AS row_cnt,
      COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id_hash, campaign_id, participated_at, supporter_type
                                        FROM ({_SUPPORTER_ROWS}))) AS duplicate_cnt,
      COUNT(*) FILTER (user_id_hash IS NULL) AS missing_key_cnt,
      {', '.join(f'COUNT(*) FILTER ({c} IS NULL) AS null_{c}'
                 for c in get_schema('supporter').columns if c != 'silver_processed_at')}
    FROM ({_SUPPORTER_ROWS})"""


def _user_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per customer; interests as a list or as JSON text, ids in three places."""
    key = F.col("c_custkey")
    words = F.transform(F.sequence(F.lit(1), (key % 4 + 1).cast("int")), lambda i: i.cast("string"))
    data = lambda interests: F.struct(
        F.struct(F.when(key % 3 > 0, key).alias("userId")).alias("userInfo"),
        (key % 5).alias("signatureCnt"),
        (key % 12).cast("string").alias("totalFundingCount"),
        interests.alias("interestKeyword"),
        (key % 2 == 0).alias("isValidJoinedPremiumMembership"),
    )
    collected = F.lit("2026-05-10T16:00:00+00:00")
    listed = _json(collected_at=collected, data=data(words))
    quoted = _json(collected_at=collected, data=data(F.to_json(words)))
    text = F.concat(F.lit("["), F.when(key % 2 == 0, listed).otherwise(quoted), F.lit("]"))
    name = F.concat(F.lit(f"landing/user_info/dt={DT}/hour=01/user_id="), key.cast("string"), F.lit(".json"))
    return read(spark, sf_dir, "customer").select(text.alias("text"), name.alias("source_key"))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_user_files(spark, sf_dir), "user_info")
    return _without_run_time(silver.build_table(records, "user_info", DT, SETTINGS))


_USER_INFO_SQL = f"""
    SELECT sha256('s:' || CAST(c_custkey AS VARCHAR)) AS user_id_hash, c_custkey % 5 AS signature_count,
      c_custkey % 12 AS total_funding_count, CAST(0 AS BIGINT) AS follower_cnt, CAST(0 AS BIGINT) AS following_cnt,
      c_custkey % 4 + 1 AS interest_count, c_custkey % 2 = 0 AS is_membership_user,
      CASE WHEN c_custkey % 12 >= 10 THEN 'high_value_backer' WHEN c_custkey % 12 >= 3 THEN 'repeat_backer'
           WHEN c_custkey % 12 >= 1 THEN 'backer' WHEN c_custkey % 5 >= 3 THEN 'active_supporter'
           WHEN c_custkey % 4 + 1 >= 3 THEN 'interest_rich_user' ELSE 'light_user' END AS user_segment,
      '20260511' AS snapshot_dt, '{DT}' AS dt
    FROM customer"""


def _detail_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per page, with the page's whole markup carried along."""
    key = F.col("page_id")
    text = _json(
        projectId=F.floor(key / 2),
        title=F.col("url"),
        status=F.when(key % 3 > 0, "success"),
        collectedAt=F.lit("2026-05-10T09:59:59+00:00"),
        isError=(key % 3 == 0).cast("int"),
        body=F.col("html"),
    )
    return read(spark, sf_dir, "pages").select(text.alias("text"), _key("detail", key).alias("source_key"))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_detail_files(spark, sf_dir), "detail")
    return _without_run_time(silver.build_table(records, "detail", DT, SETTINGS))


_DETAIL_SQL = f"""
    SELECT page_id // 2 AS campaign_id, url AS raw_title,
      CASE WHEN page_id % 3 > 0 THEN 'success' ELSE '' END AS crawl_status,
      TIMESTAMP '2026-05-10 18:59:59' AS collected_ts, page_id % 3 = 0 AS is_error, '' AS error_type, '{DT}' AS dt
    FROM pages QUALIFY row_number() OVER (PARTITION BY page_id // 2 ORDER BY page_id DESC) = 1"""


def comment_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as comments, each with ``turn % 3`` replies, flattened."""
    turns = read(spark, sf_dir, "conversations")
    count = (F.col("turn") % 3).cast("int")
    reply = lambda i: F.struct((F.col("turn") * 10 + i).alias("boardId"))
    replies = F.slice(F.transform(F.sequence(F.lit(1), F.lit(2)), reply), 1, count)
    text = _json(
        boardId=F.col("turn") * 10,
        body=F.col("text"),
        commentReplys=F.when(F.col("turn") % 4 < 3, replies),
    )
    pages = turns.select(F.col("conv_id").alias("campaign_id"), F.try_parse_json(text).alias("comment"))
    return seeds.flatten_comments(pages).select(
        "campaign_id",
        F.try_variant_get("raw", "$.boardId", "bigint").alias("board_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.coalesce(F.length(F.try_variant_get("raw", "$.body", "string")), F.lit(0)).cast("bigint").alias("body_len"),
        "status",
    )


_REPLIES_SQL = """
    SELECT conv_id AS campaign_id, turn * 10 AS board_id, CAST(0 AS BIGINT) AS depth, length(text) AS body_len,
      'success' AS status FROM conversations
    UNION ALL
    SELECT conv_id, turn * 10 + i, CAST(1 AS BIGINT), CAST(0 AS BIGINT), 'success'
    FROM conversations, generate_series(1, 2) g(i) WHERE i <= turn % 3 AND turn % 4 < 3"""


def campaign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed ids from listing payloads in four shapes, one of them broken."""
    key = F.col("o_orderkey")
    item = _json(title=F.lit("t"), campaignId=F.lit("not a number"), project_id=key.cast("double") + 0.5)
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("["), item, F.lit(",7]")))
        .when(key % 4 == 1, F.concat(F.lit('{"total":1,"projectList":['), item, F.lit("]}")))
        .when(key % 4 == 2, _json(status=F.lit("ok"), raw=F.struct(key.alias("id"))))
        .otherwise(F.concat(item, F.lit("\n"), item))
    )
    rows = seeds.seed_rows(read(spark, sf_dir, "orders").select(text.alias("text")))
    return seeds.seed_campaign_ids(rows)


_CAMPAIGN_IDS_SQL = "SELECT DISTINCT o_orderkey AS campaign_id FROM orders WHERE o_orderkey % 4 < 3"


def user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed ids from supporter payloads; ids sit in different places and some are placeholders."""
    key = F.col("o_custkey")
    text = (
        F.when(key % 4 == 0, _json(raw_text=F.struct(key.alias("encUserId")), user_id=F.lit("x")))
        .when(key % 4 == 1, _json(raw=F.struct(F.lit(" NaN ").alias("encUserId"), key.alias("memberId"))))
        .when(key % 4 == 2, _json(data=F.struct(F.lit("").alias("userId")), user_id=F.concat(F.lit(" "), key)))
        .otherwise(_json(user_id=F.lit("None")))
    )
    rows = seeds.seed_rows(read(spark, sf_dir, "orders").select(text.alias("text")))
    return seeds.seed_user_ids(rows)


_USER_IDS_SQL = "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders WHERE o_custkey % 4 < 3"

QUERIES = {
    "src_envelope_unwrap": envelope_unwrap,
    "src_comment_replies": comment_replies,
    "src_seed_campaign_ids": campaign_ids,
    "src_seed_user_ids": user_ids,
    "t1_preorder": preorder,
    "t2_comments": comments,
    "t3_supporter": supporter,
    "t4_fundings": fundings,
    "t5_wishes": wishes,
    "t6_user_info": user_info,
    "t7_detail": detail,
    "p_valid_error_split": valid_error_split,
    "ag_quality_metrics": table_quality,
}
ORACLES = {
    "src_envelope_unwrap": _ENVELOPE_SQL,
    "src_comment_replies": _REPLIES_SQL,
    "src_seed_campaign_ids": _CAMPAIGN_IDS_SQL,
    "src_seed_user_ids": _USER_IDS_SQL,
    "t1_preorder": _PREORDER_SQL,
    "t2_comments": _COMMENTS_SQL,
    "t3_supporter": _SUPPORTER_SQL,
    "t4_fundings": _FUNDINGS_SQL,
    "t5_wishes": _WISHES_SQL,
    "t6_user_info": _USER_INFO_SQL,
    "t7_detail": _DETAIL_SQL,
    "p_valid_error_split": _SPLIT_SQL,
    "ag_quality_metrics": _QUALITY_SQL,
}
