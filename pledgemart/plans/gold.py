"""KPI marts over the daily tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.measures import (
    count_where, days_left_label, has_campaign_id, or_zero, ratio, total_of,
)
from pledgemart.functions.pii import packed
from pledgemart.operators.dedup import first_per_group
from pledgemart.operators.history import change, change_rate, with_previous
from pledgemart.operators.partials import day_partials, merge_partials
from pledgemart.operators.quality import assert_public
from pledgemart.operators.staging import stage

_CAMPAIGN = "campaign_id"


def _scan(df: DataFrame, columns: str, as_of_dt: str | None = None) -> DataFrame:
    """The named columns of rows with a readable campaign id; optionally only up to a day."""
    rows = df.where(has_campaign_id(F.col(_CAMPAIGN)))
    if as_of_dt is not None:
        rows = rows.where(F.col("dt") <= as_of_dt)
    return rows.select(F.col(_CAMPAIGN).try_cast("bigint").alias(_CAMPAIGN), *columns.split())


def _asks(comments: DataFrame) -> Column:
    return (F.col("contains_question_mark") == True) | (  # noqa: E712
        F.instr(F.coalesce("keyword_groups", F.lit("")), "question") > 0
    )


def _answers() -> Column:
    return (F.col("is_maker") == True) | (F.col("is_owner") == True)  # noqa: E712


def _labelled(label: str) -> Column:
    return count_where(F.col("sentiment_label") == label).alias(f"{label}_comment_cnt")


def supporter_totals(supporter: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    """Per campaign: distinct users, purchasers and signers, and what purchasers backed.

    One row per campaign and user comes first. That replaces three distincts, which would
    multiply the rows, and spreads a large campaign over the tasks.
    """
    rows = _scan(supporter, "user_id_hash is_purchaser is_signer backing_amount", as_of_dt)
    bought = F.coalesce(F.col("is_purchaser"), F.lit(False))
    per_user = rows.groupBy(_CAMPAIGN, packed(F.col("user_id_hash")).alias("user")).agg(
        F.max(bought).alias("bought"),
        F.max(F.coalesce("is_signer", F.lit(False))).alias("signed"),
        F.sum(F.when(bought, or_zero(F.col("backing_amount"))).otherwise(0)).alias("amount"),
        F.count(F.when(bought, F.col("backing_amount"))).alias("payments"),
    )
    known = F.col("user").isNotNull()
    return per_user.groupBy(_CAMPAIGN).agg(
        F.count("user").alias("supporter_user_cnt"),
        F.count_if(known & F.col("bought")).alias("purchaser_cnt"),
        F.count_if(known & F.col("signed")).alias("signer_user_cnt"),
        F.sum("amount").alias("supporter_backing_amount"),
        ratio(F.sum("amount"), F.sum("payments")).alias("avg_supporter_backing_amount"),
    )


def supporter_partials(supporter: DataFrame, numbers: DataFrame) -> DataFrame:
    """What ``supporter_totals`` needs of each campaign and day, to be stored by day and merged."""
    rows = _scan(supporter, "dt user_id_hash is_purchaser is_signer backing_amount")
    bought = F.coalesce(F.col("is_purchaser"), F.lit(False))
    return day_partials(
        rows, numbers,
        {"supporter_user_cnt": F.lit(True), "purchaser_cnt": bought, "signer_user_cnt": F.col("is_signer")},
        {"supporter_backing_amount": F.when(bought, or_zero(F.col("backing_amount"))).otherwise(0), "payments": F.when(bought & F.col("backing_amount").isNotNull(), 1).otherwise(0)},
    )


def merged_supporter_totals(partials: DataFrame) -> DataFrame:
    """``supporter_totals`` of all days in ``partials``."""
    users = ["supporter_user_cnt", "purchaser_cnt", "signer_user_cnt"]
    totals = merge_partials(partials, users, ["supporter_backing_amount", "payments"])
    return totals.select(
        _CAMPAIGN, *users, "supporter_backing_amount",
        ratio(F.col("supporter_backing_amount"), F.col("payments")).alias("avg_supporter_backing_amount"),
    )


def funding_partials(fundings: DataFrame, numbers: DataFrame) -> DataFrame:
    """What ``funding_totals`` needs of each campaign and day."""
    rows = _scan(fundings, "dt user_id_hash amount")
    return day_partials(rows, numbers, {"funding_user_cnt": F.lit(True)}, {"user_history_funding_amount": or_zero(F.col("amount"))})


def merged_funding_totals(partials: DataFrame) -> DataFrame:
    return merge_partials(partials, ["funding_user_cnt"], ["user_history_funding_amount"])


def wish_totals(wishes: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    rows = _scan(wishes, "user_id_hash", as_of_dt)
    return rows.groupBy(_CAMPAIGN).agg(F.count_distinct(packed(F.col("user_id_hash"))).alias("wish_user_cnt"))


def comment_totals(comments: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    rows = _scan(
        comments,
        "comment_id contains_question_mark keyword_groups is_maker is_owner sentiment_score sentiment_label",
        as_of_dt,
    )
    return rows.groupBy(_CAMPAIGN).agg(
        F.count_distinct("comment_id").alias("comment_cnt"),
        count_where(_asks(rows)).alias("question_cnt"),
        count_where(_answers()).alias("answer_cnt"),
        F.avg(F.col("sentiment_score").cast("double")).alias("avg_sentiment_score"),
        _labelled("positive"),
        _labelled("negative"),
        _labelled("neutral"),
    )


def funding_totals(fundings: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    rows = _scan(fundings, "user_id_hash amount", as_of_dt)
    return rows.groupBy(_CAMPAIGN).agg(
        F.count_distinct(packed(F.col("user_id_hash"))).alias("funding_user_cnt"),
        F.sum(or_zero(F.col("amount"))).alias("user_history_funding_amount"),
    )


def campaign_kpi(
    preorder: DataFrame,
    supporter: DataFrame,
    wishes: DataFrame,
    comments: DataFrame,
    as_of_dt: str | None = None,
) -> DataFrame:
    """Latest snapshot per campaign with its supporter, wish and comment totals.

    Every input is reduced to one row per campaign and is partitioned by it, so the joins
    need no further shuffle and no campaign outweighs another.
    """
    latest = first_per_group(
        _scan(
            preorder,
            "title category_name category_code biz_model status_simplified maker_id maker_name corp_name "
            "core_message maker_club_grade has_coupon is_delivery_available is_global_shipping_available "
            "open_ts close_ts snapshot_dt snapshot_ts remaining_day achievement_rate funding_ratio "
            "target_amount total_funding_amount participation_cnt signature_cnt dt",
            as_of_dt,
        ),
        [_CAMPAIGN],
        [F.desc_nulls_last("snapshot_ts"), F.desc_nulls_last("dt")],
    )
    joined = (
        latest.join(supporter_totals(supporter, as_of_dt), _CAMPAIGN, "left")
        .join(wish_totals(wishes, as_of_dt), _CAMPAIGN, "left")
        .join(comment_totals(comments, as_of_dt), _CAMPAIGN, "left")
    )
    zeroed = lambda names: [or_zero(F.col(n)).alias(n) for n in names.split()]
    return joined.select(
        *"campaign_id title category_name category_code biz_model status_simplified maker_id maker_name".split(),
        *"corp_name core_message maker_club_grade has_coupon is_delivery_available".split(),
        *"is_global_shipping_available open_ts close_ts snapshot_dt snapshot_ts remaining_day".split(),
        days_left_label(F.col("remaining_day")).alias("remaining_day_label"),
        *"achievement_rate funding_ratio target_amount total_funding_amount participation_cnt".split(),
        "signature_cnt",
        *zeroed("supporter_user_cnt purchaser_cnt signer_user_cnt supporter_backing_amount"),
        "avg_supporter_backing_amount",
        ratio(F.col("supporter_backing_amount"), F.col("purchaser_cnt")).alias("arppu"),
        *zeroed("wish_user_cnt comment_cnt question_cnt answer_cnt"),
        "avg_sentiment_score",
        *zeroed("positive_comment_cnt negative_comment_cnt neutral_comment_cnt"),
        total_of(F.col("signature_cnt"), F.col("wish_user_cnt"), F.col("comment_cnt")).alias("reaction_cnt"),
        "dt",
    )


def campaign_daily_kpi(preorder: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    """Last snapshot per campaign and day, with changes since the previous observed day."""
    rows = _scan(
        preorder,
        "dt title category_name biz_model status_simplified remaining_day achievement_rate funding_ratio "
        "target_amount total_funding_amount participation_cnt signature_cnt snapshot_ts",
        as_of_dt,
    )
    daily = first_per_group(rows, [_CAMPAIGN, "dt"], [F.desc_nulls_last("snapshot_ts")])
    measures = "total_funding_amount participation_cnt signature_cnt achievement_rate".split()
    daily = with_previous(daily, _CAMPAIGN, "dt", {m: f"prev_{m}" for m in measures})
    changes = []
    for name, measure in [
        ("funding_amount", "total_funding_amount"),
        ("participation", "participation_cnt"),
        ("signature", "signature_cnt"),
    ]:
        changes.append(change(measure, f"prev_{measure}").alias(f"{name}_dod"))
        changes.append(change_rate(measure, f"prev_{measure}").alias(f"{name}_dod_rate"))
    return daily.select(
        *"campaign_id dt title category_name biz_model status_simplified remaining_day".split(),
        days_left_label(F.col("remaining_day")).alias("remaining_day_label"),
        *"achievement_rate funding_ratio target_amount total_funding_amount participation_cnt".split(),
        "signature_cnt",
        *[f"prev_{m}" for m in measures],
        *changes,
        change("achievement_rate", "prev_achievement_rate").alias("achievement_rate_dod"),
        "snapshot_ts",
    )


def campaign_conversion_kpi(
    campaign_kpi: DataFrame, fundings: DataFrame, as_of_dt: str | None = None
) -> DataFrame:
    joined = campaign_kpi.join(funding_totals(fundings, as_of_dt), _CAMPAIGN, "left")
    per = lambda n, d, name: ratio(F.col(n), F.col(d)).alias(name)
    return joined.select(
        *"campaign_id dt title category_name biz_model status_simplified wish_user_cnt".split(),
        *"signature_cnt participation_cnt purchaser_cnt".split(),
        or_zero(F.col("funding_user_cnt")).alias("funding_user_cnt"),
        per("purchaser_cnt", "wish_user_cnt", "wish_to_purchase_rate"),
        per("purchaser_cnt", "signature_cnt", "signature_to_purchase_rate"),
        per("participation_cnt", "wish_user_cnt", "wish_to_participation_rate"),
        *"arppu total_funding_amount achievement_rate".split(),
        or_zero(F.col("user_history_funding_amount")).alias("user_history_funding_amount"),
    )


def comment_nlp_kpi(comments: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    """Sentiment per campaign, day and keyword group; a comment counts once in each of its groups."""
    rows = _scan(comments, "dt comment_id sentiment_label sentiment_score keyword_groups", as_of_dt)
    groups = F.split(F.coalesce(F.nullif(F.col("keyword_groups"), F.lit("")), F.lit("general")), ",")
    grouped = rows.withColumn("keyword_group", F.explode(groups)).withColumn(
        "keyword_group", F.trim("keyword_group")
    )
    totals = grouped.groupBy(_CAMPAIGN, "dt", "keyword_group").agg(
        F.count_distinct("comment_id").alias("comment_cnt"),
        _labelled("positive"),
        _labelled("neutral"),
        _labelled("negative"),
        F.avg(F.col("sentiment_score").cast("double")).alias("avg_sentiment_score"),
    )
    return totals.select(
        *"campaign_id dt keyword_group comment_cnt positive_comment_cnt neutral_comment_cnt".split(),
        "negative_comment_cnt",
        ratio(F.col("positive_comment_cnt"), F.col("comment_cnt")).alias("positive_rate"),
        ratio(F.col("negative_comment_cnt"), F.col("comment_cnt")).alias("negative_rate"),
        "avg_sentiment_score",
        F.col("keyword_group").alias("keyword_group_label"),
        F.col("comment_cnt").alias("keyword_count"),
        F.col("negative_comment_cnt").alias("negative_keyword_count"),
    )


def campaign_response_performance(comments: DataFrame, as_of_dt: str | None = None) -> DataFrame:
    rows = _scan(
        comments,
        "dt comment_id contains_question_mark keyword_groups is_answered is_maker is_owner "
        "time_to_first_answer_min",
        as_of_dt,
    )
    totals = rows.groupBy(_CAMPAIGN, "dt").agg(
        F.count_distinct("comment_id").alias("comment_cnt"),
        count_where(_asks(rows)).alias("question_cnt"),
        count_where(F.col("is_answered") == True).alias("answered_question_cnt"),  # noqa: E712
        count_where(_answers()).alias("maker_answer_cnt"),
        F.avg("time_to_first_answer_min").alias("avg_time_to_first_answer_min"),
    )
    return totals.withColumn("answer_rate", ratio(F.col("answered_question_cnt"), F.col("question_cnt")))


def category_statistics(campaign_kpi: DataFrame) -> DataFrame:
    """Distinct campaigns, averages and approximate median per category.

    The distinct count runs on its own: together with the percentile it would keep one
    sketch per campaign.
    """
    average = lambda c, name: F.avg(F.col(c).cast("double")).alias(name)
    averages = campaign_kpi.groupBy("category_name").agg(
        average("total_funding_amount", "category_avg_funding_amount"),
        F.percentile_approx(F.col("total_funding_amount").cast("double"), 0.5).alias(
            "category_median_funding_amount"
        ),
        average("achievement_rate", "category_avg_achievement_rate"),
        average("participation_cnt", "category_avg_participation_cnt"),
        average("signature_cnt", "category_avg_signature_cnt"),
        average("wish_user_cnt", "category_avg_wish_user_cnt"),
        average("comment_cnt", "category_avg_comment_cnt"),
    )
    counts = campaign_kpi.groupBy("category_name").agg(
        F.count_distinct(_CAMPAIGN).alias("category_campaign_cnt")
    )
    return averages.join(counts, "category_name")


def campaign_category_benchmark(campaign_kpi: DataFrame) -> DataFrame:
    """Each campaign beside the figures of its category.

    The category side is small as a rule, but nothing bounds it: AQE broadcasts it if its
    measured size allows, else it splits a category that holds much of the campaigns.
    What is read of the mart is staged, a row per campaign: each of the three readers would build it anew.
    """
    selected = "total_funding_amount achievement_rate participation_cnt signature_cnt wish_user_cnt comment_cnt"
    base = campaign_kpi.where(F.col("category_name").isNotNull())
    base = stage(base.select(*"campaign_id dt title category_name".split(), *selected.split()))
    stats = category_statistics(base)
    against = lambda own, avg, name: ratio(F.col(own), F.col(avg)).alias(name)
    return base.join(stats, "category_name", "left").select(
        *"campaign_id dt title category_name".split(),
        *[F.col(c).alias(f"selected_{c}") for c in selected.split()],
        *"category_campaign_cnt category_avg_funding_amount category_median_funding_amount".split(),
        *"category_avg_achievement_rate category_avg_participation_cnt category_avg_signature_cnt".split(),
        *"category_avg_wish_user_cnt category_avg_comment_cnt".split(),
        against("total_funding_amount", "category_avg_funding_amount", "selected_vs_category_avg_funding_ratio"),
        against("achievement_rate", "category_avg_achievement_rate", "selected_vs_category_avg_achievement_ratio"),
        against("participation_cnt", "category_avg_participation_cnt",
                "selected_vs_category_avg_participation_ratio"),
    )


MARTS = [
    "campaign_kpi",
    "campaign_daily_kpi",
    "campaign_conversion_kpi",
    "comment_nlp_kpi",
    "campaign_response_performance",
    "campaign_category_benchmark",
]


def public_view(mart: str, df: DataFrame) -> DataFrame:
    """What may leave the platform: the campaign mart without ``maker_id``, the others as they are."""
    return assert_public(df.select(*fv.PUBLIC_CAMPAIGN_COLUMNS) if mart == "campaign_kpi" else df)
