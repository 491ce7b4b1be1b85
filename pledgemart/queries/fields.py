"""Field lookup, casts, null rules, dedup and the column functions, one query each."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions import casts, classify, formats, pii, text as nlp, times
from pledgemart.operators.conform import first_present, pick_first_present
from pledgemart.operators.dedup import keep_last
from pledgemart.operators.history import latest_and_previous
from pledgemart.queries import views
from pledgemart.queries.views import LEXICON, SALT, read, whole, with_views


def _with_record(df: DataFrame, **fields) -> DataFrame:
    """Add a record made of the given columns, in the form the landing reader gives."""
    text = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    return df.select(
        "*", F.try_parse_json(text).alias("record"), F.lit(None).cast("map<string,string>").alias("parent"),
        F.lit("key").alias("source_key"), F.struct(F.lit(0).alias("at")).alias("read_order"),
    )


def coalesce_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id sits in one of three fields, two of which differ only in case; '' beats a later title."""
    key = F.col("o_orderkey")
    rows = _with_record(
        read(spark, sf_dir, "orders"),
        campaignId=F.when(key % 3 == 0, key),
        campaignid=F.when(key % 3 < 2, (key * 10).cast("string")),
        project_id=key * 100,
        title=F.when(key % 2 == 0, ""),
        campaignTitle=F.col("o_orderpriority"),
    )
    wanted = {n: fv.PREORDER_FIELDS[n] for n in ("campaign_id", "title", "maker_name")}
    return pick_first_present(rows, wanted, key).select(
        F.col("o_orderkey").alias("order_key"), F.col("campaign_id").cast("bigint").alias("campaign_id"),
        "title", F.coalesce("maker_name", F.lit("none")).alias("maker_name"),
    )


_COALESCE_SQL = """
    SELECT o_orderkey AS order_key,
      CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey * 10 ELSE o_orderkey * 100 END AS campaign_id,
      CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS title, 'none' AS maker_name
    FROM orders"""


def nested_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One and two levels down; a container that is no object gives the default."""
    key = F.col("c_custkey")
    inner = F.struct(
        F.struct(F.when(key % 3 > 0, key).alias("userId")).alias("userInfo"), (key % 5).alias("signatureCnt")
    )
    rows = _with_record(
        read(spark, sf_dir, "customer"),
        data=F.when(key % 4 > 0, F.to_json(inner)).otherwise("plain text"),
    ).withColumn(
        "record",
        F.when(key % 4 > 0, F.try_parse_json(F.concat(F.lit('{"data":'), F.to_json(inner), F.lit("}"))))
        .otherwise(F.col("record")),
    )
    return rows.select(
        key.alias("custkey"),
        first_present("data.userInfo.userId").cast("bigint").alias("user_id"),
        first_present("data.signatureCnt", "-1").cast("bigint").alias("signature_cnt"),
    )


_NESTED_SQL = """
    SELECT c_custkey AS custkey, CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 > 0 THEN c_custkey END AS user_id,
      CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 5 ELSE -1 END AS signature_cnt
    FROM customer"""


def _pick_by(key, *values):
    out = F.when(key % len(values) == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        out = out.when(key % len(values) == i, value)
    return out


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    digits = key.cast("string")
    number = _pick_by(
        key, digits, F.concat(digits, F.lit(".0")), F.concat(digits, F.lit(".5")), F.lit("abc"),
        F.concat(F.lit(" -"), digits, F.lit(" ")), F.concat(digits, F.lit("d")), F.lit(""),
    )
    word = _pick_by(key, F.lit(" TRUE "), F.lit("0"), F.lit("Yes"), F.lit("maybe"), F.lit("f"), F.lit("1"))
    return read(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        casts.to_long(number).alias("as_long"),
        casts.to_double(number).alias("as_double"),
        casts.to_boolean(word).alias("as_boolean"),
    )


_CASTS_SQL = """
    SELECT o_orderkey AS order_key,
      CASE o_orderkey % 7 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey WHEN 4 THEN -o_orderkey END AS as_long,
      CASE o_orderkey % 7 WHEN 0 THEN CAST(o_orderkey AS DOUBLE) WHEN 1 THEN CAST(o_orderkey AS DOUBLE)
        WHEN 2 THEN CAST(o_orderkey AS DOUBLE) + CAST(0.5 AS DOUBLE) WHEN 4 THEN -CAST(o_orderkey AS DOUBLE) END AS as_double,
      CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 4 THEN false WHEN 5 THEN true END AS as_boolean
    FROM orders"""


def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing becomes 0, '' or false; present but unreadable becomes NULL; other columns stay NULL."""
    key = F.col("l_orderkey")
    given = lambda good, bad: _pick_by(key, good, bad, F.lit(None).cast("string"))
    ruled = lambda name, value, dtype: casts.cast_text(
        casts.fill_missing(name, value, as_text=True), dtype
    ).alias(name)
    rows = read(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        ruled("remaining_day", given(F.lit("3"), F.lit("abc")), "bigint"),
        ruled("amount", given(whole(F.col("l_extendedprice")).cast("string"), F.lit("-")), "bigint"),
        ruled("title", given(F.col("l_returnflag"), F.lit(" ")), "string"),
        ruled("is_adult", given(F.lit("y"), F.lit("?")), "boolean"),
        ruled("maker_id", given(F.lit("9"), F.lit("x")), "bigint"),
    )
    names = "remaining_day amount title is_adult maker_id".split()
    return rows.groupBy("l_suppkey").agg(
        *[F.count(n).alias(f"{n}_cnt") for n in names],
        F.sum("amount").alias("amount"), F.sum("remaining_day").alias("remaining_day"),
        F.count_if(F.col("title") == "").alias("empty_titles"), F.count_if("is_adult").alias("adults"),
    )


_NULL_RULES_SQL = """
    SELECT l_suppkey, COUNT(*) FILTER (m <> 1) AS remaining_day_cnt, COUNT(*) FILTER (m <> 1) AS amount_cnt,
      COUNT(*) AS title_cnt, COUNT(*) FILTER (m <> 1) AS is_adult_cnt, COUNT(*) FILTER (m = 0) AS maker_id_cnt,
      CAST(SUM(CASE m WHEN 0 THEN CAST(floor(l_extendedprice) AS BIGINT) WHEN 2 THEN 0 END) AS BIGINT) AS amount,
      CAST(SUM(CASE m WHEN 0 THEN 3 WHEN 2 THEN 0 END) AS BIGINT) AS remaining_day,
      COUNT(*) FILTER (m = 2) AS empty_titles, COUNT(*) FILTER (m = 0) AS adults
    FROM (SELECT *, l_orderkey % 3 AS m FROM lineitem) GROUP BY l_suppkey"""


def last_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user and type in time order; a third of the users are NULL, and equal."""
    rows = read(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("user_id"),
        "event_type", "event_id", F.struct("ts", "event_id").alias("read_order"),
    )
    return keep_last(rows, ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


_LAST_KEPT_SQL = """
    SELECT CASE WHEN user_id % 3 > 0 THEN user_id END AS user_id, event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY CASE WHEN user_id % 3 > 0 THEN user_id END, event_type
                               ORDER BY ts DESC, event_id DESC) = 1"""


def latest_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight from the snapshots: many share a day, the last of each day counts."""
    return latest_and_previous(
        views.preorder(spark, sf_dir), "campaign_id", "dt",
        ["total_funding_amount", "participation_cnt"], tie_break=["snapshot_ts"],
    )


_LATEST_SQL = with_views("""
    SELECT campaign_id, MAX(dt) FILTER (r = 1) AS latest_date, MAX(dt) FILTER (r = 2) AS prev_date,
      MAX(total_funding_amount) FILTER (r = 1) AS total_funding_amount,
      MAX(participation_cnt) FILTER (r = 1) AS participation_cnt,
      MAX(total_funding_amount) FILTER (r = 2) AS prev_total_funding_amount,
      MAX(participation_cnt) FILTER (r = 2) AS prev_participation_cnt
    FROM (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY dt DESC) AS r
          FROM (SELECT * FROM ad_preorder
                QUALIFY row_number() OVER (PARTITION BY campaign_id, dt ORDER BY snapshot_ts DESC) = 1))
    WHERE r <= 2 GROUP BY campaign_id""", "ad_preorder")


def hash_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    raw = _pick_by(key, key.cast("string"), F.concat(F.lit(" \t"), key, F.lit("\n")), F.lit("  "))
    path = F.concat(F.lit("a/dt=20260510/user_id="), key, F.lit(".json"))
    return read(spark, sf_dir, "customer").select(
        key.alias("custkey"),
        pii.salted_hash(raw, SALT).alias("user_id_hash"),
        pii.salted_hash(pii.user_id_from_path(F.when(key % 2 == 0, path).otherwise("a/part.json")), SALT).alias(
            "path_hash"
        ),
    )


_HASH_SQL = """
    SELECT c_custkey AS custkey,
      CASE WHEN c_custkey % 3 < 2 THEN sha256('s:' || CAST(c_custkey AS VARCHAR)) END AS user_id_hash,
      CASE WHEN c_custkey % 2 = 0 THEN sha256('s:' || CAST(c_custkey AS VARCHAR)) END AS path_hash
    FROM customer"""


def kst_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time in one of seven spellings, and unreadable ones."""
    ts, key = F.date_trunc("second", "ts").cast("timestamp_ntz"), F.col("event_id")
    at = ts.cast("timestamp")
    form = lambda pattern: F.date_format(ts, pattern)
    text = _pick_by(
        key,
        form("yyyy-MM-dd'T'HH:mm:ss'+00:00'"), form("yyyy-MM-dd HH:mm:ss"), form("yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.unix_millis(at).cast("string"), F.unix_seconds(at).cast("string"), form("yyyyMMddHHmmss"),
        form("yyyy/M/d HH:mm:ss"), F.lit("soon"), F.lit("2024-13-45"),
    )
    path = F.concat(F.lit("x/hour="), F.date_format(ts, "HH"), F.lit("/part.json"))
    return read(spark, sf_dir, "events").select(
        "event_id",
        times.to_kst(text).alias("kst"),
        times.kst_from_path(F.when(key % 4 > 0, path).otherwise("x/part.json"), "20240131").alias("from_path"),
    )


_KST_SQL = """
    SELECT event_id, CASE WHEN event_id % 9 < 7 THEN date_trunc('second', ts) + INTERVAL 9 HOUR END AS kst,
      TIMESTAMP '2024-01-31 00:00:00' + INTERVAL 9 HOUR
        + to_hours(CASE WHEN event_id % 4 > 0 THEN hour(ts) ELSE 0 END) AS from_path
    FROM events"""


def dt_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, key = F.col("ts"), F.col("event_id")
    spelled = _pick_by(
        key, F.date_format(ts, "yyyyMMdd"), F.date_format(ts, " yyyy-MM-dd"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("never"),
    )
    return read(spark, sf_dir, "events").select(
        "event_id",
        times.date_key(ts).alias("date_key"),
        times.hour_of(ts).alias("hour"),
        times.day_of_week(ts).alias("dow"),
        times.normalize_dt_column(spelled).alias("dt"),
        F.coalesce(F.when(key % 2 == 0, ts), times.midnight("20240131")).alias("ts_or_midnight"),
    )


_DT_KEYS_SQL = """
    SELECT event_id, strftime(ts, '%Y%m%d') AS date_key, CAST(hour(ts) AS BIGINT) AS hour,
      CAST(isodow(ts) - 1 AS BIGINT) AS dow,
      CASE WHEN event_id % 4 < 3 THEN strftime(ts, '%Y%m%d') END AS dt,
      CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '2024-01-31 00:00:00' END AS ts_or_midnight
    FROM events"""


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = nlp.clean_text(F.col("html"))
    pages = read(spark, sf_dir, "pages").select("page_id", text.alias("text"))
    return pages.withColumn("length", nlp.content_length(F.col("text")))


# The entities the pages hold are these four, the last one also without its semicolon.
_CLEAN_TEXT_SQL = r"""
    SELECT page_id, text, length(text) AS length FROM (
      SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'),
        '<[^>]+>', ' ', 'g'), '[\x00-\x1f\x7f]', ' ', 'g'), '[\s\x{00a0}]+', ' ', 'g')) AS text
      FROM pages)"""


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    docs = docs.select("doc_id", nlp.sentiment_balance(F.col("text"), LEXICON).alias("balance"))
    return docs.select(
        "doc_id",
        nlp.sentiment_label(F.col("balance")).alias("label"),
        nlp.sentiment_score(F.col("balance")).alias("score"),
    )


_BALANCE = " ".join(
    f"{sign} contains(lower(text), '{w}')::INT"
    for sign, words in (("+", LEXICON.positive), ("-", LEXICON.negative)) for w in words
)
_SENTIMENT_SQL = f"""
    SELECT doc_id, CASE WHEN b > 0 THEN 'positive' WHEN b < 0 THEN 'negative' ELSE 'neutral' END AS label,
      CAST(sign(b) AS BIGINT) AS score
    FROM (SELECT doc_id, {_BALANCE} AS b FROM documents)"""


#: Words by rule: all of three and two of the commonest letters, which overlap everywhere.
_LETTERS = "etaoinshrdlu"


def _strings(letters: str, length: int) -> list[str]:
    return ["".join(signs) for signs in itertools.product(letters, repeat=length)]


def large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance and groups of every text by a lexicon of 1,872 words."""
    lexicon = nlp.Lexicon(
        positive=_strings(_LETTERS, 3), negative=_strings(_LETTERS, 2), lower=True,
        groups={"open": _strings("eaoiu", 3), "closed": _strings("tnshr", 3)},
    )
    docs = read(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", nlp.sentiment_balance(F.col("text"), lexicon).cast("bigint").alias("balance"),
        nlp.keyword_groups(F.col("text"), lexicon).alias("keyword_groups"),
    )


_LARGE_LEXICON_SQL = f"""
    WITH letters AS (SELECT unnest(string_split('{_LETTERS}', '')) AS c),
    words AS (SELECT a.c || b.c || d.c AS w, 1 AS weight FROM letters a, letters b, letters d
      UNION ALL SELECT a.c || b.c, -1 FROM letters a, letters b),
    docs AS (SELECT row_number() OVER () AS n, doc_id, lower(text) AS t FROM documents),
    found AS (SELECT n, doc_id, w, weight FROM docs JOIN words ON contains(t, w))
    SELECT docs.doc_id, CAST(if(any_value(t) IS NULL, NULL, coalesce(sum(weight), 0)) AS BIGINT) AS balance,
      concat_ws(',', if(bool_or(regexp_full_match(w, '[eaoiu]{{3}}')), 'open', NULL), if(bool_or(regexp_full_match(w, '[tnshr]{{3}}')), 'closed', NULL))
        AS keyword_groups
    FROM docs LEFT JOIN found USING (n) GROUP BY n, docs.doc_id"""


def keyword_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(
        "doc_id", nlp.keyword_groups(F.col("text"), LEXICON).alias("keyword_groups")
    )


_GROUPS_SQL = """
    SELECT doc_id, concat_ws(',', CASE WHEN contains(lower(text), 'que') THEN 'question' END,
      CASE WHEN contains(lower(text), 'der') THEN 'delivery' END,
      CASE WHEN contains(lower(text), 'tion') THEN 'usage' END) AS keyword_groups
    FROM documents"""


def question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a question word or mark put behind some of them."""
    tail = _pick_by(
        F.col("doc_id"), F.lit(""), F.lit("?"), F.lit("？ "), F.lit("되나요"), F.lit("될까요."), F.lit("문의"), F.lit("!")
    )
    return read(spark, sf_dir, "documents").select(
        "doc_id", nlp.is_question(F.concat("text", tail)).alias("asks"),
        nlp.content_length(F.concat("text", tail)).alias("length"),
    )


_QUESTION_SQL = """
    SELECT doc_id, contains(text, '?') OR doc_id % 7 BETWEEN 1 AND 5 AS asks,
      length(text) + CASE doc_id % 7 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4
        WHEN 5 THEN 2 ELSE 1 END AS length
    FROM documents"""


def supporter_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    kind = _pick_by(
        key, F.lit("Purchase"), F.lit("FUNDING"), F.lit("signature"), F.lit("구매"), F.lit("view"), F.lit("지지"),
        F.lit(None).cast("string"),
    )
    amount = _pick_by(key, F.lit("0"), F.lit("x"), F.col("o_totalprice").cast("string"))
    return read(spark, sf_dir, "orders").select(
        key.alias("order_key"), classify.is_purchaser(kind, amount).alias("is_purchaser"),
        classify.is_signer(kind).alias("is_signer"),
    )


_SUPPORTER_CLASS_SQL = """
    SELECT o_orderkey AS order_key,
      o_orderkey % 7 IN (0, 1, 3) OR (o_orderkey % 3 = 2 AND o_totalprice > 0) AS is_purchaser,
      o_orderkey % 7 IN (2, 5) AS is_signer
    FROM orders"""


def amount_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("o_orderkey") % 10 > 0, whole(F.col("o_totalprice")) - 500)
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), classify.amount_tier(amount).alias("tier")
    )


_TIER_SQL = """
    SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 10 = 0 OR a <= 0 THEN 'unknown' WHEN a < 30000 THEN 'under_30k'
      WHEN a < 100000 THEN '30k_100k' WHEN a < 300000 THEN '100k_300k' ELSE 'over_300k' END AS tier
    FROM (SELECT *, floor(o_totalprice) - 500 AS a FROM orders)"""


def action_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    kind = _pick_by(key, F.lit(" reward "), F.lit("PreOrder"), F.lit("  "), F.lit(None).cast("string"), F.col("p_type"))
    return read(spark, sf_dir, "part").select(key.alias("partkey"), classify.action_type(kind).alias("action_type"))


_ACTION_SQL = """
    SELECT p_partkey AS partkey, CASE WHEN p_partkey % 5 < 4 THEN 'funding' ELSE lower(p_type) END AS action_type
    FROM part"""


def user_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = views.user_info(spark, sf_dir)
    fewer = F.col("total_funding_count") - 6
    return users.select(
        "user_id_hash",
        classify.user_segment(fewer, F.col("signature_count"), F.col("interest_count")).alias("segment"),
    )


_SEGMENT_SQL = with_views("""
    SELECT user_id_hash, CASE WHEN f >= 10 THEN 'high_value_backer' WHEN f >= 3 THEN 'repeat_backer'
      WHEN f >= 1 THEN 'backer' WHEN signature_count >= 3 THEN 'active_supporter'
      WHEN interest_count >= 3 THEN 'interest_rich_user' ELSE 'light_user' END AS segment
    FROM (SELECT *, total_funding_count - 6 AS f FROM ad_user_info)""", "ad_user_info")


def wish_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    ended = casts.to_double(_pick_by(F.col("event_id"), F.lit("0"), F.lit("1"), F.lit("n/a"), F.lit(None).cast("string")))
    left = F.when(F.col("event_id") % 5 > 0, whole(F.col("value")) % 5 - 2)
    return read(spark, sf_dir, "events").select("event_id", classify.wish_is_active(ended, left).alias("is_active"))


_WISH_ACTIVE_SQL = """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN true WHEN event_id % 4 = 1 THEN false
      WHEN event_id % 5 > 0 THEN CAST(floor(value) AS BIGINT) % 5 - 2 >= 0 END AS is_active
    FROM events"""


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    code = _pick_by(key, F.lit("TECH"), F.lit(" FOOD "), F.lit(""), F.lit(None).cast("string"), F.col("p_brand"))
    status = _pick_by(key, F.lit("OPEN"), F.lit("open"))
    model = _pick_by(key, F.lit("STORE"), F.lit("PREORDER"), F.lit("OTHER"))
    named = F.when(key % 7 == 0, F.col("p_name"))
    return read(spark, sf_dir, "part").select(
        key.alias("partkey"),
        F.coalesce(named, classify.category_name(code)).alias("category_name"),
        classify.status_name(status).alias("status"),
        classify.biz_model_name(model).alias("biz_model"),
    )


_CODE_MAP_SQL = """
    SELECT p_partkey AS partkey,
      CASE WHEN p_partkey % 7 = 0 THEN p_name WHEN p_partkey % 5 = 0 THEN '테크/가전' WHEN p_partkey % 5 = 1 THEN '푸드'
        WHEN p_partkey % 5 = 4 THEN p_brand END AS category_name,
      CASE WHEN p_partkey % 2 = 0 THEN '진행중' ELSE 'open' END AS status,
      CASE p_partkey % 3 WHEN 0 THEN '스토어' WHEN 1 THEN '예약구매' ELSE 'OTHER' END AS biz_model
    FROM part"""


def interest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    words = F.to_json(F.transform(F.sequence(F.lit(1), (key % 6 + 1).cast("int")), lambda i: i.cast("string")))
    text = _pick_by(key, words, F.lit("[]"), F.lit("12"), F.lit("[broken"), F.lit(None).cast("string"))
    return read(spark, sf_dir, "customer").select(
        key.alias("custkey"), classify.interest_count(text).alias("interest_count")
    )


_INTEREST_SQL = """
    SELECT c_custkey AS custkey, CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 6 + 1 ELSE 0 END AS interest_count
    FROM customer"""


def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals printed in every scale, signs included."""
    key = F.col("o_orderkey")
    scale = _pick_by(key, F.lit(0.01), F.lit(1.0), F.lit(1000.0), F.lit(-1.0), F.lit(0.0))
    value = whole(F.col("o_totalprice")).cast("double") * scale
    share = (key % 1000 - 300).cast("double") / 256.0
    return read(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        formats.krw(value).alias("krw"),
        formats.number(value).alias("number"),
        formats.pct(share).alias("pct"),
        formats.pp(share).alias("pp"),
        formats.date_text(F.when(key % 5 > 0, F.col("o_orderdate"))).alias("date_text"),
        formats.dday(F.when(key % 5 > 0, (key % 41 - 20).cast("string")).otherwise("x")).alias("dday"),
        formats.delta_direction(value).alias("direction"),
        formats.delta_text(value, "krw").alias("delta_text"),
    )


_KRW = """CASE WHEN abs({v}) >= 100000000 THEN format('{{:,.1f}}', {v} / CAST(100000000 AS DOUBLE)) || '억 원'
        WHEN abs({v}) >= 10000 THEN format('{{:,.0f}}', {v} / CAST(10000 AS DOUBLE)) || '만 원'
        ELSE format('{{:,.0f}}', {v}) || '원' END"""
_PCT = "format('{{:.1f}}', CASE WHEN abs({s}) <= 1 THEN {s} * CAST(100 AS DOUBLE) ELSE {s} END)"
_FORMATS_SQL = f"""
    SELECT k AS order_key, {_KRW.format(v='v')} AS krw, format('{{:,.0f}}', v) AS number,
      {_PCT.format(s='s')} || '%' AS pct, {_PCT.format(s='s')} || '%p' AS pp,
      CASE WHEN k % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '-' END AS date_text,
      CASE WHEN k % 5 = 0 THEN 'D-' WHEN k % 41 >= 20 THEN 'D-' || CAST(k % 41 - 20 AS VARCHAR)
        ELSE 'D+' || CAST(20 - k % 41 AS VARCHAR) END AS dday,
      CASE WHEN v > 0 THEN 'up' WHEN v < 0 THEN 'down' ELSE 'flat' END AS direction,
      CASE WHEN v > 0 THEN '+' || {_KRW.format(v='abs(v)')} WHEN v < 0 THEN '-' || {_KRW.format(v='abs(v)')}
        ELSE '0' END AS delta_text
    FROM (SELECT o_orderkey AS k, o_orderdate, CAST(o_orderkey % 1000 - 300 AS DOUBLE) / CAST(256 AS DOUBLE) AS s,
            CAST(floor(o_totalprice) AS DOUBLE) * CAST(CASE o_orderkey % 5 WHEN 0 THEN 0.01 WHEN 1 THEN 1
              WHEN 2 THEN 1000 WHEN 3 THEN -1 ELSE 0 END AS DOUBLE) AS v FROM orders)"""

QUERIES = {
    "p_coalesce_candidates": coalesce_candidates,
    "p_nested_value": nested_value,
    "p_typed_casts": typed_casts,
    "p_null_rules": null_rules,
    "set_keep_last_dedup": last_kept,
    "w_latest_prev": latest_previous,
    "fn_hash_pii": hash_pii,
    "fn_kst_time": kst_time,
    "fn_dt_keys": dt_keys,
    "fn_clean_text": clean_text,
    "fn_sentiment": sentiment,
    "fn_keyword_groups": keyword_groups,
    "fn_large_lexicon": large_lexicon,
    "fn_question": question,
    "fn_supporter_class": supporter_class,
    "fn_amount_tier": amount_tier,
    "fn_action_type": action_type,
    "fn_interest_count": interest_count,
    "fn_user_segment": user_segment,
    "fn_wish_active": wish_active,
    "fn_code_map": code_map,
    "fn_formats": number_formats,
}
ORACLES = {
    "p_coalesce_candidates": _COALESCE_SQL,
    "p_nested_value": _NESTED_SQL,
    "p_typed_casts": _CASTS_SQL,
    "p_null_rules": _NULL_RULES_SQL,
    "set_keep_last_dedup": _LAST_KEPT_SQL,
    "w_latest_prev": _LATEST_SQL,
    "fn_hash_pii": _HASH_SQL,
    "fn_kst_time": _KST_SQL,
    "fn_dt_keys": _DT_KEYS_SQL,
    "fn_clean_text": _CLEAN_TEXT_SQL,
    "fn_sentiment": _SENTIMENT_SQL,
    "fn_keyword_groups": _GROUPS_SQL,
    "fn_large_lexicon": _LARGE_LEXICON_SQL,
    "fn_question": _QUESTION_SQL,
    "fn_supporter_class": _SUPPORTER_CLASS_SQL,
    "fn_amount_tier": _TIER_SQL,
    "fn_action_type": _ACTION_SQL,
    "fn_interest_count": _INTEREST_SQL,
    "fn_user_segment": _SEGMENT_SQL,
    "fn_wish_active": _WISH_ACTIVE_SQL,
    "fn_code_map": _CODE_MAP_SQL,
    "fn_formats": _FORMATS_SQL,
}
