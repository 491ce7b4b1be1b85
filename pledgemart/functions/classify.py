"""Labels derived from one row's values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import blank_to_null, strip, to_double


def code_name(code: Column, names: dict[str, str]) -> Column:
    """Name of a code; an unknown code names itself, a blank one is NULL."""
    key = blank_to_null(code)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, key), key)


def category_name(code: Column) -> Column:
    return code_name(code, fv.CATEGORY_NAMES)


def status_name(code: Column) -> Column:
    return code_name(code, fv.STATUS_NAMES)


def biz_model_name(code: Column) -> Column:
    return code_name(code, fv.BIZ_MODEL_NAMES)


def _type_matches(supporter_type: Column, pattern: str) -> Column:
    return F.lower(F.coalesce(supporter_type, F.lit(""))).rlike(pattern)


def is_purchaser(supporter_type: Column, amount_text: Column) -> Column:
    paid = F.coalesce(to_double(amount_text), F.lit(0.0)) > 0
    return _type_matches(supporter_type, fv.PURCHASER_PATTERN) | paid


def is_signer(supporter_type: Column) -> Column:
    return _type_matches(supporter_type, fv.SIGNER_PATTERN)


def amount_tier(amount: Column) -> Column:
    value = F.coalesce(amount.cast("double"), F.lit(0.0))
    tier = F.when(value <= 0, fv.AMOUNT_TIER_NONE)
    for bound, name in fv.AMOUNT_TIERS:
        tier = tier.when(value < bound, name)
    return tier.otherwise(fv.AMOUNT_TIER_TOP)


def action_type(product_type: Column) -> Column:
    kind = strip(product_type)
    funding = F.upper(kind).isin(fv.FUNDING_PRODUCT_TYPES) | (kind == "") | kind.isNull()
    return F.when(funding, "funding").otherwise(F.lower(kind))


def interest_count(interests_json: Column) -> Column:
    """Length of a list, or of a list written as JSON text; anything else counts 0."""
    return F.coalesce(F.json_array_length(interests_json), F.lit(0)).cast("bigint")


def user_segment(fundings: Column, signatures: Column, interests: Column) -> Column:
    fundings, signatures, interests = (
        F.coalesce(c.cast("double"), F.lit(0.0)) for c in (fundings, signatures, interests)
    )
    return (
        F.when(fundings >= 10, "high_value_backer")
        .when(fundings >= 3, "repeat_backer")
        .when(fundings >= 1, "backer")
        .when(signatures >= 3, "active_supporter")
        .when(interests >= 3, "interest_rich_user")
        .otherwise("light_user")
    )


def wish_is_active(ended: Column, remaining_days: Column) -> Column:
    """By the ended flag (0 is running) where it is a number, else by the days left."""
    return F.coalesce(ended == 0, remaining_days >= 0)
