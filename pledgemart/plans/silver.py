"""Raw records to the daily tables.

Each transform takes the record rows of ``sources.landing`` and returns the conformed
table plus ``read_order``, before dedup.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pledgemart import fixed_values as fv
from pledgemart.functions import classify, pii, text as nlp, times
from pledgemart.functions.casts import to_double
from pledgemart.operators.conform import either_container, enforce_schema, pick_first_present, read_fields
from pledgemart.operators.dedup import keep_last
from pledgemart.registry import get_schema


@dataclass(frozen=True)
class Settings:
    """What a transform needs besides its records."""

    hash_salt: str = ""
    lexicon: nlp.Lexicon = field(default_factory=lambda: nlp.DEFAULT_LEXICON)
    processed_at: datetime | None = None


def _texts(fields: dict[str, str], *without: str) -> dict[str, Column]:
    return {name: F.col(name) for name in fields if name not in without}


def preorder(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    snapshot_ts = F.coalesce(
        times.to_kst(F.col("snapshot_ts")), times.kst_from_path(F.col("source_key"), dt), times.midnight(dt)
    )
    picked = pick_first_present(records, fv.PREORDER_FIELDS).withColumn("snapshot_ts", snapshot_ts)
    text = _texts(fv.PREORDER_FIELDS, "snapshot_ts")
    text["category_name"] = F.coalesce("category_name", classify.category_name(F.col("category_code")))
    text["status_simplified"] = classify.status_name(F.col("status_simplified"))
    text["biz_model"] = classify.biz_model_name(F.col("biz_model"))
    typed = {
        "snapshot_ts": F.col("snapshot_ts"),
        "snapshot_dt": F.coalesce(times.date_key(F.col("snapshot_ts")), F.lit(dt)),
    }
    return enforce_schema(
        picked, get_schema("preorder"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def comments(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    picked = (
        pick_first_present(records, fv.COMMENT_FIELDS)
        .withColumn("body", nlp.clean_text(F.col("comment_body")))
        .withColumn("comment_ts", times.to_kst(F.col("comment_ts")))
        .withColumn("balance", nlp.sentiment_balance(F.col("body"), settings.lexicon))
    )
    typed = {
        "author_id_hash": pii.salted_hash(F.col("author_id"), settings.hash_salt),
        "comment_ts": F.col("comment_ts"),
        "comment_date": times.date_key(F.col("comment_ts")),
        "comment_body_cleaned": F.col("body"),
        "content_length": nlp.content_length(F.col("body")),
        "keyword_groups": nlp.keyword_groups(F.col("body"), settings.lexicon),
        "sentiment_label": nlp.sentiment_label(F.col("balance")),
        "sentiment_score": nlp.sentiment_score(F.col("balance")),
        "contains_question_mark": nlp.is_question(F.col("body")),
    }
    text = _texts(fv.COMMENT_FIELDS, "author_id", "comment_ts", "comment_body")
    return enforce_schema(
        picked, get_schema("comments"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def supporter(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    participated_at = F.coalesce(times.to_kst(F.col("participated_at")), times.midnight(dt))
    picked = pick_first_present(
        records, {name: either_container(c) for name, c in fv.SUPPORTER_FIELDS.items()}
    ).withColumn("participated_at", participated_at)
    kind = F.col("supporter_type")
    text = _texts(fv.SUPPORTER_FIELDS, "user_id", "participated_at")
    text["raw_support_type"] = kind
    typed = {
        "user_id_hash": pii.salted_hash(F.col("user_id"), settings.hash_salt),
        "participated_at": F.col("participated_at"),
        "participated_date": times.date_key(F.col("participated_at")),
        "is_purchaser": classify.is_purchaser(kind, F.col("backing_amount")),
        "is_signer": classify.is_signer(kind),
    }
    return enforce_schema(
        picked, get_schema("supporter"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def _user_hash(settings: Settings) -> Column:
    user_id = F.coalesce("user_id", pii.user_id_from_path(F.col("source_key")))
    return pii.salted_hash(user_id, settings.hash_salt)


def fundings(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    funded_at = F.coalesce(times.to_kst(F.col("funded_at")), times.midnight(dt))
    picked = pick_first_present(records, fv.FUNDING_FIELDS).withColumn("funded_at", funded_at)
    typed = {
        "user_id_hash": _user_hash(settings),
        "action_type": classify.action_type(F.col("product_type")),
        "funded_at": F.col("funded_at"),
        "funded_date": times.date_key(F.col("funded_at")),
        "funded_hour": times.hour_of(F.col("funded_at")),
        "funded_dow": times.day_of_week(F.col("funded_at")),
        "amount_tier": classify.amount_tier(to_double(F.col("amount"))),
    }
    text = _texts(fv.FUNDING_FIELDS, "user_id", "funded_at")
    return enforce_schema(
        picked, get_schema("fundings"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def _with_flags(records: DataFrame, candidates: dict[str, str]) -> DataFrame:
    """``records`` with text columns: of each the first present field, a JSON ``true`` or ``false`` as 1 or 0.

    All fields come from one pass over the record, as they are; their kind decides afterwards.
    """
    paths = [p for names in candidates.values() for p in names.split()]
    found, places = read_fields(records, paths, *records.columns, leaf=T.VariantType())

    def value(path: str) -> Column:
        text = F.col(places[path]).try_cast("string")
        number = F.col(places[path]).try_cast("double").cast("string")
        return F.when(text.isin("true", "false"), F.coalesce(number, text)).otherwise(text)

    flags = [F.coalesce(*[value(p) for p in names.split()]).alias(name) for name, names in candidates.items()]
    return found.select(*records.columns, *flags)


def wishes(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    fields = dict(fv.WISH_FIELDS)
    flags = {n: fields.pop(n) for n in ("ended_flag", "remaining_for_active")}
    snapshot_at = F.coalesce(times.to_kst(F.col("snapshot_at")), times.midnight(dt))
    picked = pick_first_present(_with_flags(records, flags), fields, *flags).withColumn("snapshot_at", snapshot_at)
    snapshot_dt = F.coalesce(times.date_key(F.col("snapshot_at")), F.lit(dt))
    typed = {
        "user_id_hash": _user_hash(settings),
        "snapshot_at": F.col("snapshot_at"),
        "snapshot_dt": snapshot_dt,
        "wish_snapshot_date": snapshot_dt,
        "is_active_at_snapshot": classify.wish_is_active(
            to_double(F.col("ended_flag")), to_double(F.col("remaining_for_active"))
        ),
    }
    text = _texts(fields, "user_id", "snapshot_at")
    return enforce_schema(
        picked, get_schema("wishes"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def user_info(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    picked = pick_first_present(records, fv.USER_INFO_FIELDS).withColumn(
        "interest_count", classify.interest_count(F.col("interests"))
    )
    typed = {
        "user_id_hash": _user_hash(settings),
        "interest_count": F.col("interest_count"),
        "snapshot_dt": F.coalesce(times.date_key(times.to_kst(F.col("collected_at"))), F.lit(dt)),
        "user_segment": classify.user_segment(
            to_double(F.col("total_funding_count")), to_double(F.col("signature_count")), F.col("interest_count")
        ),
    }
    text = _texts(fv.USER_INFO_FIELDS, "user_id", "interests", "collected_at")
    return enforce_schema(
        picked, get_schema("user_info"), dt, text=text, typed=typed, processed_at=settings.processed_at
    )


def detail(records: DataFrame, dt: str, settings: Settings = Settings()) -> DataFrame:
    picked = pick_first_present(records, fv.DETAIL_FIELDS)
    return enforce_schema(
        picked, get_schema("detail"), dt, text=_texts(fv.DETAIL_FIELDS), typed={},
        processed_at=settings.processed_at,
    )


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "preorder": preorder,
    "comments": comments,
    "supporter": supporter,
    "fundings": fundings,
    "wishes": wishes,
    "user_info": user_info,
    "detail": detail,
}


def load_transform(table: str) -> Callable[..., DataFrame]:
    get_schema(table)
    return TRANSFORMS[table]


def build_table(records: DataFrame, table: str, dt: str, settings: Settings = Settings()) -> DataFrame:
    """The table of one day: conformed and deduplicated, not yet split by validity."""
    schema = get_schema(table)
    conformed = load_transform(table)(records, dt, settings)
    return keep_last(conformed, schema.dedup_keys).select(*schema.columns)
