"""Ids for the next crawl, taken from landed files, and flattened comment pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import strip
from pledgemart.functions.times import normalize_dt
from pledgemart.operators.conform import read_fields
from pledgemart.sources.landing import _as_items, _only, _wrapped_list


def read_payloads(spark: SparkSession, base: str, table: str, dt: str) -> DataFrame:
    """Text of all of the day's ``.json`` files."""
    root = f"{base.rstrip('/')}/{table}/dt={normalize_dt(dt)}"
    options = {"pathGlobFilter": "*.json", "recursiveFileLookup": True}
    try:
        files = spark.read.options(**options).text(root, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "text string")
    return files.select(F.col("value").alias("text"))


def seed_rows(payloads: DataFrame) -> DataFrame:
    """Objects of each payload: of a list, of the first known list field, else the object itself.

    A payload that is not exactly one JSON document is skipped. Rows are left out by exploding
    what remains: a filter would be pushed below the parsing and repeat it.
    """
    docs = payloads.select(_as_items(F.make_valid_utf8("text")).alias("items"))
    docs = docs.select(_only(F.col("items")).alias("doc"))
    rows = F.coalesce(
        F.col("doc").try_cast("array<variant>"), _wrapped_list("doc", fv.SEED_LIST_FIELDS), F.array("doc")
    )
    objects = F.filter(rows, lambda row: row.try_cast("struct<id:string>").isNotNull())
    return docs.select(F.explode(objects).alias("row"))


def seed_campaign_ids(rows: DataFrame) -> DataFrame:
    """Distinct ids in order: of each row the first id field that reads as a whole number.

    The row's own fields come first, then those of the first of ``raw``, ``raw_text`` and
    ``data`` that holds anything.
    """
    containers = ("raw", "raw_text", "data")
    nested = [f"{c}.{f}" for c in containers for f in fv.SEED_CAMPAIGN_ID_FIELDS]
    held = [F.try_variant_get("row", f"$.{c}", "string").alias(c) for c in containers[:2]]
    fields, places = read_fields(
        rows, [*fv.SEED_CAMPAIGN_ID_FIELDS, *nested], *held, record="row", leaf=T.LongType()
    )

    def within(prefix: str) -> Column:
        return F.coalesce(*[F.col(places[f"{prefix}{f}"]) for f in fv.SEED_CAMPAIGN_ID_FIELDS])

    def is_filled(container: str) -> Column:
        return F.col(container).isNotNull() & ~F.col(container).isin("", "0", "false", "{}", "[]")

    inner = F.when(is_filled("raw"), within("raw.")).when(is_filled("raw_text"), within("raw_text."))
    first = F.coalesce(within(""), inner.otherwise(within("data.")))
    ids = fields.select(F.explode(F.array_compact(F.array(first))).alias("campaign_id"))
    return ids.distinct().orderBy("campaign_id")


def seed_user_ids(rows: DataFrame, cap: int | None = None) -> DataFrame:
    """Distinct user ids in order, all of them; a cap, if asked for, keeps the first ones in that order.

    Of each row the first usable id counts: in ``raw_text``, ``raw``, ``data``, then on the row.
    """
    paths = [f"{c}.{f}" for c in ("raw_text", "raw", "data") for f in fv.SEED_USER_ID_FIELDS_NESTED]
    paths += fv.SEED_USER_ID_FIELDS_TOP
    fields, places = read_fields(rows, paths, record="row")
    values = F.transform(F.array(*[F.col(places[p]) for p in paths]), strip)
    usable = F.filter(values, lambda v: ~F.lower(v).isin("", *fv.NOT_A_USER_ID))
    ids = fields.select(F.explode(F.slice(usable, 1, 1)).alias("user_id"))
    ids = ids.distinct().orderBy("user_id")
    return ids if cap is None else ids.limit(cap)


def flatten_comments(comments: DataFrame, campaign: str = "campaign_id", comment: str = "comment") -> DataFrame:
    """Each comment at depth 0 and each of its replies at depth 1, under the comment's campaign."""
    replies = F.coalesce(
        F.try_variant_get(comment, "$.commentReplys", "array<variant>"), F.array().cast("array<variant>")
    )
    level = lambda raw, depth: F.struct(raw.alias("raw"), F.lit(depth).alias("depth"))
    rows = F.concat(F.array(level(F.col(comment), 0)), F.transform(replies, lambda r: level(r, 1)))
    return comments.select(campaign, F.explode(rows).alias("c")).select(
        campaign, "c.raw", "c.depth", F.lit("success").alias("status")
    )
