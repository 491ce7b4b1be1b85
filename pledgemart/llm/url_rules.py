"""URL filters by association rules.

Spark's FP-growth mines combinations of URL tokens that go along with a verdict: the transactions
are the token sets of labelled URLs with their label as one more item, and of the rules it finds
those count that end in a label and reach the least support and confidence. Rules are matched by an
inverted index: each is listed under the rarest of its tokens, a URL looks up its own tokens, and
the rest of a rule is compared then. Of the rules that match, the most confident decides, then the
better supported, the longer, and the first by name. Fixed list rules come before all of them.

URLs with the same tokens are matched once. Everything is column expressions and Spark's own miner.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pledgemart.llm.common import pick, stage

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"
LABEL = "verdict="

ListRule = tuple[str, str, str]  # verdict, host, path


def _lower(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From behind the first :// to the next /, ?, # or the end; else empty."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From behind the host to the next ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules: list[ListRule]) -> Column:
    """The longest list rule that fits, as a struct (rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, ascending: scheme, host, its site, end and labels, words of the
    path without digits, file ending, names of parameters, and whether there is a fragment."""
    host, path = host_of(url), _lower(path_of(url))
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    named = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(f"{kind}:"), x))
    words = F.filter(F.split(path, "[/._-]+"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    one = lambda kind, value: F.when(value != "", F.array(F.concat(F.lit(f"{kind}:"), value))).otherwise(F.array().cast("array<string>"))
    parts = F.concat(
        one("scheme", _lower(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))),
        one("host", host), one("site", F.substring_index(host, ".", -2)), one("end", F.substring_index(host, ".", -1)),
        named("label", labels), named("path", words), one("file", F.regexp_extract(path, r"\.([a-z]{1,5})$", 1)),
        named("query", names), F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.coalesce(F.array_sort(F.array_distinct(parts)), F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) from ``labelled`` (tokens, label).

    Rows without a label or tokens are left out; without any row there is no rule. The share
    ``min_support`` is of the rows that are left.
    """
    items = labelled.filter("label IS NOT NULL AND size(tokens) > 0").select(
        F.array_append("tokens", F.concat(F.lit(LABEL), "label")).alias("items")
    )
    items = stage(items)
    if items.isEmpty():
        return _no_rules(labelled.sparkSession)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith(LABEL))
    return rules.select(
        F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("verdict"),
        "confidence", "support",
    )


def _no_rules(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(
        F.array(F.lit("")).alias("tokens"), F.lit("").alias("verdict"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")
    )


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, verdict, rule_tokens, confidence) of the distinct token sets that a rule matches."""
    rules = stage(rules.withColumn("id", F.monotonically_increasing_id()))
    listed = rules.select("id", F.explode("tokens").alias("token"))
    held = listed.groupBy("token").agg(F.count("*").alias("held"))
    # The token in the fewest rules stands for the rarest: it makes the shortest list.
    under = listed.join(held, "token").groupBy("id").agg(F.min(F.struct("held", "token")).alias("least"))
    index = rules.join(under, "id").select(F.col("least.token").alias("token"), F.col("tokens").alias("rule_tokens"), "verdict", "confidence", "support")
    looked_up = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    fits = looked_up.filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    order = F.struct("confidence", "support", F.size("rule_tokens").alias("size"), "rule_tokens", "verdict")
    best = fits.groupBy("tokens").agg(F.max(order).alias("best"))
    return best.select("tokens", "best.verdict", "best.rule_tokens", "best.confidence")


def judge(
    pages: DataFrame, labels: DataFrame, list_rules: list[ListRule],
    min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence of every row of ``pages`` (page_id, url).

    Labels are the verdicts of the list rules, and for the other pages those of ``labels`` (page_id,
    label: allow or block; an id that has both has none). A URL that no rule fits is allowed. A null
    URL has neither host nor path; repeated rows are judged alike and each weighs in the mining.
    """
    rows = pick(pages, "page_id", "url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), tokens_of(F.col("url")).alias("tokens"))
    rows = stage(rows.withColumn("listed", list_rule(F.col("host"), F.col("path"), list_rules)))
    given = labels.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    given = given.filter("label = other").select("page_id", "label")
    listed = rows.filter("listed IS NOT NULL").select("tokens", F.col("listed.verdict").alias("label"))
    others = rows.filter("listed IS NULL").join(given, "page_id").select("tokens", "label")
    rules = mine(listed.union(others), min_support, min_confidence)
    open_ = rows.filter("listed IS NULL AND size(tokens) > 0").select("tokens").distinct()
    found = stage(match(open_, rules)).withColumnsRenamed({"verdict": "mined", "rule_tokens": "mined_rule"})
    return rows.join(found, "tokens", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined", F.lit(DEFAULT)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.array_join("mined_rule", " ")).alias("mined_rule"),
        F.when(F.col("listed").isNull(), F.col("confidence")).alias("confidence"),
    )
