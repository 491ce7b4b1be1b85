"""Dashboard and platform datasets over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart.functions.measures import ratio
from pledgemart.operators.staging import stage
from pledgemart.plans import present
from pledgemart.queries import marts, views
from pledgemart.queries.views import VIEW_SQL, with_views


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart with the columns the dashboard takes if they are there."""
    daily = marts.campaign_daily_kpi(spark, sf_dir)
    return daily.select(
        "*",
        (F.col("participation_cnt") * 3 + F.col("signature_cnt")).alias("detail_views"),
        ratio(F.col("signature_cnt"), F.col("participation_cnt")).alias("daily_conversion_rate"),
        F.col("funding_ratio").alias("cumulative_conversion_rate"),
        F.col("signature_dod").alias("wish_dod"),
        F.col("participation_dod").alias("comment_dod"),
    )


VIEW_SQL["daily"] = (["campaign_daily_kpi"], """
    SELECT *, participation_cnt * 3 + signature_cnt AS detail_views,
      CAST(signature_cnt AS DOUBLE) / participation_cnt AS daily_conversion_rate,
      funding_ratio AS cumulative_conversion_rate, signature_dod AS wish_dod, participation_dod AS comment_dod
    FROM campaign_daily_kpi""")


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.campaign_snapshot(
        marts.campaign_kpi(spark, sf_dir), _daily(spark, sf_dir), marts.comment_nlp_kpi(spark, sf_dir)
    )


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


VIEW_SQL["snapshot"] = (["daily", "campaign_kpi", "comment_nlp_kpi"], f"""
    SELECT c.campaign_id, c.title, {_d('c.target_amount')} AS target_amount, a.dt AS latest_date, b.dt AS prev_date,
      {_d('a.total_funding_amount')} AS amount, {_d('a.achievement_rate')} AS achievement,
      {_d('a.participation_cnt')} AS participation, {_d('a.signature_cnt')} AS signature,
      {_d('a.detail_views')} AS daily_views, a.daily_conversion_rate AS daily_conversion,
      {_d('c.comment_cnt')} AS comments,
      {_d('a.total_funding_amount - COALESCE(b.total_funding_amount, a.total_funding_amount)')} AS amount_delta,
      {_d('a.achievement_rate - COALESCE(b.achievement_rate, a.achievement_rate)')} AS achievement_delta,
      {_d('a.participation_cnt - COALESCE(b.participation_cnt, a.participation_cnt)')} AS participation_delta,
      {_d('a.signature_cnt - COALESCE(b.signature_cnt, a.signature_cnt)')} AS signature_delta,
      {_d('a.detail_views - COALESCE(b.detail_views, a.detail_views)')} AS daily_views_delta,
      a.daily_conversion_rate - COALESCE(b.daily_conversion_rate, a.daily_conversion_rate) AS daily_conversion_delta,
      {_d('0')} AS comments_delta, COALESCE(n.pos, {_d('0')}) AS positive_rate, COALESCE(n.neg, {_d('0')}) AS negative_rate
    FROM campaign_kpi c
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY dt DESC) AS r FROM daily) a
      ON a.campaign_id = c.campaign_id AND a.r = 1
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY dt DESC) AS r FROM daily) b
      ON b.campaign_id = c.campaign_id AND b.r = 2
    LEFT JOIN (SELECT campaign_id, {_d('SUM(positive_comment_cnt)')} / {_d('SUM(comment_cnt)')} AS pos,
                 {_d('SUM(negative_comment_cnt)')} / {_d('SUM(comment_cnt)')} AS neg
               FROM comment_nlp_kpi GROUP BY campaign_id) n ON n.campaign_id = c.campaign_id""")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir)


def _krw(v: str) -> str:
    return f"""CASE WHEN abs({v}) >= 100000000 THEN format('{{:,.1f}}', {v} / {_d('100000000')}) || '억 원'
      WHEN abs({v}) >= 10000 THEN format('{{:,.0f}}', {v} / {_d('10000')}) || '만 원'
      ELSE format('{{:,.0f}}', {v}) || '원' END"""


def _points(v: str, unit: str) -> str:
    return f"format('{{:.1f}}', CASE WHEN abs({v}) <= 1 THEN {v} * {_d('100')} ELSE {v} END) || '{unit}'"


def _card_sql(no: int, name: str, kind: str) -> str:
    printed = {"krw": _krw, "number": lambda v: f"format('{{:,.0f}}', {v})"}
    shown = printed.get(kind, lambda v: _points(v, "%"))
    moved = printed.get(kind, lambda v: _points(v, "%p"))
    d = f"{name}_delta"
    return f"""SELECT campaign_id, CAST({no} AS INTEGER) AS card_no, '{name}' AS metric, {name} AS value, {d} AS delta,
      {shown(name)} AS value_text,
      CASE WHEN {d} > 0 THEN 'up' WHEN {d} < 0 THEN 'down' ELSE 'flat' END AS direction,
      CASE WHEN {d} > 0 THEN '+' || {moved(f'abs({d})')} WHEN {d} < 0 THEN '-' || {moved(f'abs({d})')}
        ELSE '0' END AS delta_text
    FROM snapshot"""


_CARD_KINDS = [
    ("amount", "krw"), ("achievement", "pct"), ("participation", "number"), ("signature", "number"),
    ("daily_views", "number"), ("daily_conversion", "rate"),
]
_CARDS_SQL = with_views(
    "\nUNION ALL ".join(_card_sql(i, *card) for i, card in enumerate(_CARD_KINDS, start=1)), "snapshot")


def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.kpi_cards(_snapshot(spark, sf_dir))


def check_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.check_points(_snapshot(spark, sf_dir))


_GAP = f"greatest(target_amount - amount, {_d('0')})"
_CHECKS_SQL = with_views(f"""
    SELECT campaign_id, {_GAP} AS target_gap, {_krw(_GAP)} AS target_gap_text, amount_delta,
      CASE WHEN amount_delta > 0 THEN 'up' ELSE 'down' END AS momentum,
      CASE WHEN daily_conversion_delta > 0 THEN 'up' WHEN daily_conversion_delta < 0 THEN 'down' ELSE 'flat' END
        AS conversion_trend,
      negative_rate, negative_rate >= {_d('0.15')} AS negative_alert
    FROM snapshot""", "snapshot")


def funding_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change derived here, as the dashboard does for a table without it."""
    daily = marts.campaign_daily_kpi(spark, sf_dir)
    return present.funding_series(daily.select("campaign_id", "dt", "total_funding_amount"))


_FUNDING_SERIES_SQL = with_views("""
    SELECT campaign_id, dt, total_funding_amount, COALESCE(funding_amount_dod, 0) AS funding_amount_dod
    FROM campaign_daily_kpi""", "campaign_daily_kpi")


def behaviour_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.behaviour_series(_daily(spark, sf_dir))


def _unpivot(view: str, ids: str, labels: dict[str, str], name: str, value: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {ids}, '{label}' AS {name}, {_d(column)} AS {value} FROM {view}" for column, label in labels.items()
    )


_BEHAVIOUR_SQL = with_views(_unpivot("daily", "campaign_id, dt", present.BEHAVIOUR_LABELS, "metric", "value"), "daily")


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.funnel(marts.campaign_kpi(spark, sf_dir), _daily(spark, sf_dir))


_FUNNEL_SQL = with_views(f"""
    SELECT campaign_id, stage_no, stage, value,
      value / first_value(value) OVER (PARTITION BY campaign_id ORDER BY stage_no) * {_d('100')} AS pct_of_first
    FROM (SELECT campaign_id, unnest([1, 2, 3]) AS stage_no, unnest(['상세조회', '관심등록', '참여']) AS stage,
            unnest([{_d('detail_views')}, {_d('COALESCE(wish_dod, 0)')}, {_d('participation_cnt')}]) AS value
          FROM (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY dt DESC) = 1))
    WHERE value > 0""", "daily")


def conversion_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.conversion_series(_daily(spark, sf_dir))


_CONVERSION_SQL = with_views(f"""
    SELECT campaign_id, dt, metric,
      CASE WHEN MAX(abs(value)) OVER (PARTITION BY campaign_id, metric) <= 1 THEN value * {_d('100')} ELSE value END AS value
    FROM ({_unpivot('daily', 'campaign_id, dt', present.RATE_LABELS, 'metric', 'value')})""", "daily")


def amount_per_participant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.amount_per_participant(_snapshot(spark, sf_dir))


_ARPPU = f"CASE WHEN participation = 0 THEN {_d('0')} ELSE amount / participation END"
_PER_HEAD_SQL = with_views(f"SELECT campaign_id, {_ARPPU} AS arppu, {_krw(f'({_ARPPU})')} AS arppu_text FROM snapshot", "snapshot")


def comment_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.comment_words(views.comments(spark, sf_dir))


VIEW_SQL["comment_words"] = (["ad_comments"], r"""
    SELECT campaign_id, sentiment_label AS sentiment, word, COUNT(*) AS count
    FROM (SELECT campaign_id, sentiment_label, unnest(string_split(trim(regexp_replace(
            regexp_replace(comment_body_cleaned, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS word
          FROM ad_comments)
    WHERE word <> '' GROUP BY 1, 2, 3""")


def word_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = comment_words(spark, sf_dir)
    spelled = words.withColumn("sentiment", F.when(F.col("sentiment") == "positive", " POS ").otherwise("negative!"))
    positive = present.words_of_sentiment(spelled, "positive")
    negative = present.words_of_sentiment(spelled, "negative")
    return present.word_cloud(positive.unionByName(negative))


_CLOUD_SQL = with_views(f"""
    SELECT campaign_id, sentiment, word, CAST(n AS BIGINT) AS count, w AS weight,
      format('{{:.1f}}', 13 + w * 15) AS font_size, CAST(floor(520 + w * 330) AS BIGINT) AS font_weight,
      format('{{:.3f}}', {_d('0.38')} + w * {_d('0.60')}) AS opacity,
      CAST(CASE WHEN r % 2 = 0 THEN k // 2 - r // 2 ELSE k // 2 + (r - 1) // 2 END AS BIGINT) AS place
    FROM (SELECT *, (n - MIN(n) OVER g) / greatest(MAX(n) OVER g - MIN(n) OVER g, {_d('1')}) AS w, COUNT(*) OVER g AS k
          FROM (SELECT *, row_number() OVER (PARTITION BY campaign_id, sentiment ORDER BY n DESC, word) AS r,
                  greatest(2, ceil(MAX(n) OVER (PARTITION BY campaign_id, sentiment) * {_d('0.18')})) AS least_n
                FROM (SELECT campaign_id, word, {_d('SUM(count)')} AS n,
                        CASE WHEN sentiment = 'positive' THEN ' POS ' ELSE 'negative!' END AS sentiment
                      FROM comment_words GROUP BY 1, 2, 4))
          WHERE r <= 28 AND n >= least_n
          WINDOW g AS (PARTITION BY campaign_id, sentiment))""", "comment_words")


def sentiment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.sentiment_share(marts.comment_nlp_kpi(spark, sf_dir))


_SUMS = ", ".join(f"SUM({c}) AS {c}" for c in present.SENTIMENT_LABELS)
_SHARE_SQL = with_views(_unpivot(
    f"(SELECT campaign_id, {_SUMS} FROM comment_nlp_kpi GROUP BY campaign_id)",
    "campaign_id", present.SENTIMENT_LABELS, "sentiment", "comment_cnt"), "comment_nlp_kpi")


def sentiment_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.sentiment_series(marts.comment_nlp_kpi(spark, sf_dir))


_SENTIMENT_SERIES_SQL = with_views(_unpivot(
    "comment_nlp_kpi", "campaign_id, dt, keyword_group", present.SENTIMENT_LABELS, "sentiment", "comment_cnt"),
    "comment_nlp_kpi")


def snapshot_other_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot from marts that call their figures by the other names."""
    camp = marts.campaign_kpi(spark, sf_dir).withColumnsRenamed({
        "total_funding_amount": "total_backed_amount", "participation_cnt": "supporter_count", "comment_cnt": "comment_count",
    })
    daily = _daily(spark, sf_dir).withColumnsRenamed({"participation_cnt": "supporter_count", "detail_views": "Detail_View_Cnt"})
    return present.campaign_snapshot(camp, daily, marts.comment_nlp_kpi(spark, sf_dir))


def headline_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wish rate is missing for some campaigns, the view rate stands under another spelling."""
    rates = marts.campaign_kpi(spark, sf_dir).withColumns({
        "View_To_Participation_Rate": F.col("participation_cnt").cast("double") / 7,
        "wish_to_participation_rate": F.when(F.col("campaign_id") % 2 == 0, F.col("signature_cnt").cast("double") / 9),
    })
    return present.headline_rates(rates).select("campaign_id", "view_to_participation_rate", "wish_to_participation_rate")


_HEADLINE_SQL = with_views(f"""
    SELECT campaign_id, COALESCE({_d('participation_cnt')} / 7, 0) AS view_to_participation_rate,
      CASE WHEN campaign_id % 2 = 0 THEN COALESCE({_d('signature_cnt')} / 9, 0) ELSE {_d('0')} END AS wish_to_participation_rate
    FROM campaign_kpi""", "campaign_kpi")


# Means of quotients depend in the last bits on the order of the sum; both engines round them.
_DIGITS = 9


def _summary(campaign_kpi: DataFrame) -> DataFrame:
    summary = present.category_summary(campaign_kpi)
    return summary.withColumns({c: F.round(c, _DIGITS) for c in ("avg_positive_rate", "avg_negative_rate")})


def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(marts.campaign_kpi(spark, sf_dir))


VIEW_SQL["rated"] = (["campaign_kpi"], """
    SELECT *, CASE WHEN comment_cnt > 0 THEN CAST(positive_comment_cnt AS DOUBLE) / comment_cnt END AS positive_rate,
      CASE WHEN comment_cnt > 0 THEN CAST(negative_comment_cnt AS DOUBLE) / comment_cnt END AS negative_rate
    FROM campaign_kpi""")
VIEW_SQL["category_summary"] = (["rated"], f"""
    SELECT category_name, COUNT(*) AS campaign_cnt, AVG({_d('total_funding_amount')}) AS avg_funding_amount,
      AVG(achievement_rate) AS avg_achievement_rate, AVG({_d('participation_cnt')}) AS avg_participation_cnt,
      AVG({_d('signature_cnt')}) AS avg_signature_cnt, round(AVG(positive_rate), {_DIGITS}) AS avg_positive_rate,
      round(AVG(negative_rate), {_DIGITS}) AS avg_negative_rate,
      quantile_cont({_d('total_funding_amount')}, 0.5) AS median_funding_amount
    FROM rated WHERE category_name IS NOT NULL GROUP BY category_name""")


def performance_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the category summary; categories of odd number lack a funding benchmark of their own."""
    # Read by the summary and by the index, so built once for both.
    columns = "campaign_id category_name total_funding_amount achievement_rate participation_cnt signature_cnt"
    comments = "positive_comment_cnt negative_comment_cnt comment_cnt"
    mart = stage(marts.campaign_kpi(spark, sf_dir).select(*columns.split(), *comments.split()))
    bench = _summary(mart)
    known = F.regexp_extract("category_name", r"(\d+)$", 1).cast("int") % 2 == 0
    bench = bench.withColumn("avg_funding_amount", F.when(known, F.col("avg_funding_amount")))
    index = present.performance_index(mart, bench)
    return index.select(
        "campaign_id", "category_name", "metric_no", "metric",
        *[F.round(c, 6).alias(c) for c in ("value", "category_average", "index", "index_difference")],
        "index_label", "higher_is_better",
    )


def _index_sql(no: int, column: str, average: str, higher: bool) -> str:
    own, base = f"COALESCE({_d(f'r.{column}')}, {_d('0')})", f"NULLIF(s.{average}, 0)"
    index = (f"{own} / {base} * {_d('100')}" if higher
             else f"CASE WHEN {own} = 0 THEN {_d('160')} ELSE {base} / {own} * {_d('100')} END")
    return f"""SELECT r.campaign_id, r.category_name, CAST({no} AS INTEGER) AS metric_no, '{column}' AS metric,
      round({own}, 6) AS value, round({base}, 6) AS category_average, round({index}, 6) AS index,
      round({index} - 100, 6) AS index_difference, CAST(round({index}, 0) AS BIGINT) AS index_label,
      {str(higher).lower()} AS higher_is_better
    FROM rated r JOIN category_summary s ON r.category_name = s.category_name WHERE {base} IS NOT NULL"""


_INDEX_SQL = with_views("\nUNION ALL ".join(
    _index_sql(i, *spec) for i, spec in enumerate([
        ("total_funding_amount", "avg_funding_amount", True), ("achievement_rate", "avg_achievement_rate", True),
        ("participation_cnt", "avg_participation_cnt", True), ("signature_cnt", "avg_signature_cnt", True),
        ("positive_rate", "avg_positive_rate", True), ("negative_rate", "avg_negative_rate", False),
    ], start=1)), "rated", "category_summary")


def platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.platform_metrics(marts.campaign_kpi(spark, sf_dir))


_PLATFORM_SQL = with_views(f"""
    SELECT 'campaign_count' AS section, 'campaigns' AS name, {_d('COUNT(*)')} AS value FROM campaign_kpi
    UNION ALL SELECT 'category_avg_funding_amount', category_name, AVG({_d('total_funding_amount')})
      FROM campaign_kpi WHERE category_name IS NOT NULL GROUP BY category_name
    UNION ALL SELECT 'category_avg_achievement_rate', category_name, AVG(achievement_rate)
      FROM campaign_kpi WHERE category_name IS NOT NULL GROUP BY category_name
    UNION ALL SELECT 'participation_distribution', CASE WHEN p >= 10000 THEN '10000+' WHEN p >= 1000 THEN '1000-9999'
        WHEN p >= 100 THEN '100-999' WHEN p >= 10 THEN '10-99' WHEN p >= 1 THEN '1-9' ELSE '0' END, {_d('COUNT(*)')}
      FROM (SELECT COALESCE(participation_cnt, 0) AS p FROM campaign_kpi) GROUP BY 2
    UNION ALL SELECT 'sentiment_ratio', 'positive', {_d('SUM(positive_comment_cnt)')} / {_d('SUM(comment_cnt)')} FROM campaign_kpi
    UNION ALL SELECT 'sentiment_ratio', 'negative', {_d('SUM(negative_comment_cnt)')} / {_d('SUM(comment_cnt)')} FROM campaign_kpi
    """, "campaign_kpi")


def picker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.campaign_picker(marts.campaign_kpi(spark, sf_dir))


_PICKER_SQL = with_views("""
    SELECT campaign_id, maker_name, title || ' · ' || CAST(campaign_id AS VARCHAR) || ' · ' || status_simplified || ' · '
      || CASE WHEN remaining_day >= 0 THEN 'D-' || CAST(remaining_day AS VARCHAR)
         ELSE 'D+' || CAST(-remaining_day AS VARCHAR) END AS label,
      status_simplified, remaining_day, total_funding_amount
    FROM campaign_kpi""", "campaign_kpi")


def makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.makers(views.preorder(spark, sf_dir))


_MAKERS_SQL = with_views("SELECT DISTINCT maker_name FROM ad_preorder", "ad_preorder")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the given tables, read whole."""
    names = "region nation customer supplier part orders lineitem events conversations documents embeddings pages benchmark labels".split()
    return present.manifest({name: views.read(spark, sf_dir, name) for name in names})


_MANIFEST_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", COUNT(*) AS rows, CAST({columns} AS BIGINT) AS columns, "
    f"CASE WHEN COUNT(*) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM {name}"
    for name, columns in [("region", 2), ("nation", 3), ("customer", 5), ("supplier", 4), ("part", 6), ("orders", 6),
                          ("lineitem", 11), ("events", 6), ("conversations", 4), ("documents", 5), ("embeddings", 3),
                          ("pages", 3), ("benchmark", 2), ("labels", 3)])

QUERIES = {
    "d1_snapshot": snapshot,
    "d1_snapshot_other_names": snapshot_other_names,
    "d4_headline_rates": headline_rates,
    "d1_kpi_cards": kpi_cards,
    "d2_check_points": check_points,
    "d3_funding_series": funding_series,
    "d3_behaviour_series": behaviour_series,
    "d4_funnel": funnel,
    "d4_conversion_series": conversion_series,
    "d4_amount_per_participant": amount_per_participant,
    "d5_comment_words": comment_words,
    "d5_word_cloud": word_cloud,
    "d6_sentiment_share": sentiment_share,
    "d6_sentiment_series": sentiment_series,
    "d7_performance_index": performance_index,
    "d8_category_summary": category_summary,
    "d9_platform_metrics": platform,
    "s_campaign_picker": picker,
    "s_makers": makers,
    "ag_manifest": manifest,
}
ORACLES = {
    "d1_snapshot": with_views("SELECT * FROM snapshot", "snapshot"),
    "d1_snapshot_other_names": with_views("SELECT * FROM snapshot", "snapshot"),
    "d4_headline_rates": _HEADLINE_SQL,
    "d1_kpi_cards": _CARDS_SQL,
    "d2_check_points": _CHECKS_SQL,
    "d3_funding_series": _FUNDING_SERIES_SQL,
    "d3_behaviour_series": _BEHAVIOUR_SQL,
    "d4_funnel": _FUNNEL_SQL,
    "d4_conversion_series": _CONVERSION_SQL,
    "d4_amount_per_participant": _PER_HEAD_SQL,
    "d5_comment_words": with_views("SELECT * FROM comment_words", "comment_words"),
    "d5_word_cloud": _CLOUD_SQL,
    "d6_sentiment_share": _SHARE_SQL,
    "d6_sentiment_series": _SENTIMENT_SERIES_SQL,
    "d7_performance_index": _INDEX_SQL,
    "d8_category_summary": with_views("SELECT * FROM category_summary", "category_summary"),
    "d9_platform_metrics": _PLATFORM_SQL,
    "s_campaign_picker": _PICKER_SQL,
    "s_makers": _MAKERS_SQL,
    "ag_manifest": _MANIFEST_SQL,
}
