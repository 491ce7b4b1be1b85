"""Column functions against plain Python, and invariants on random frames."""

import hashlib
import html
import random
import re
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions import casts, classify, formats, pii, text as nlp, times
from pledgemart.operators.dedup import first_per_group, keep_last
from pledgemart.operators.median import exact_median
from pledgemart.operators.quality import split_valid_and_error
from pledgemart.plans import present
from pledgemart.registry import get_schema


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {dtype}").coalesce(1)
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def python_clean(value):
    value = re.sub(r"<[^>]+>", " ", html.unescape(value or ""))
    return re.sub(r"\s+", " ", re.sub(r"[\x00-\x1f\x7f]", " ", value)).strip()


def test_clean_text_like_python(spark):
    pieces = ["a", "<b>", "</b >", "<", ">", "&amp;", "&lt;p&gt;", "&nbsp;", "&#44032;", "&#x41;", "&copy", "&notit;",
              "&unknown;", "&", " ", "\t\n", "\x07", " ", "　", " ", "배송", "&ampx", "é"]
    rng = random.Random(7)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None]
    assert column(spark, texts, nlp.clean_text) == [python_clean(t) for t in texts]


def test_lexicon_rules_like_python(spark):
    words = fv.POSITIVE_KEYWORDS + fv.NEGATIVE_KEYWORDS + sum(fv.KEYWORD_GROUPS.values(), []) + ["가", "?"]
    rng = random.Random(3)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(300)]
    balance = [sum(w in t for w in fv.POSITIVE_KEYWORDS) - sum(w in t for w in fv.NEGATIVE_KEYWORDS) for t in texts]
    assert column(spark, texts, lambda c: nlp.sentiment_score(nlp.sentiment_balance(c))) == [
        (b > 0) - (b < 0) for b in balance]
    assert column(spark, texts, nlp.keyword_groups) == [
        ",".join(g for g, ws in fv.KEYWORD_GROUPS.items() if any(w in t for w in ws)) for t in texts]
    assert column(spark, texts, nlp.is_question) == [bool(re.search(fv.QUESTION_PATTERN, t)) for t in texts]


def test_numbers_like_python(spark):
    values = [0.0, 1.0, -1.0, 0.5, 0.005, 0.0125, 1.25, 2.25, 2.5, 9999.5, 10000.0, 15000.0, 25000.0, -25000.0,
              99999999.0, 1e8, 1.25e8, -2.5e8, 123456789012.0]
    krw = lambda v: (f"{v / 1e8:,.1f}억 원" if abs(v) >= 1e8 else f"{v / 1e4:,.0f}만 원" if abs(v) >= 1e4 else f"{v:,.0f}원")
    assert column(spark, values, formats.krw, "double") == [krw(v) for v in values]
    assert column(spark, values, formats.number, "double") == [f"{v:,.0f}" for v in values]
    assert column(spark, values, formats.pct, "double") == [f"{v * 100 if abs(v) <= 1 else v:.1f}%" for v in values]
    assert column(spark, [None], formats.krw, "double") == ["0원"]
    assert column(spark, ["3", "0", "-2.7", "2.9", "x", None], formats.dday) == ["D-3", "D-0", "D+2", "D-2", "D-", "D-"]


@pytest.mark.parametrize("text, long, double", [
    ("12", 12, 12.0), (" 12 ", 12, 12.0), ("12.0", 12, 12.0), ("12.5", None, 12.5), ("1e3", 1000, 1000.0),
    ("abc", None, None), ("", None, None), ("12d", None, None), ("nan", None, None), ("-7", -7, -7.0),
    ("9223372036854775807", 9223372036854775807, 9.223372036854775807e18), ("99999999999999999999", None, 1e20),
    ("true", None, None), (".5", None, 0.5), ("5.", 5, 5.0),
])
def test_number_casts(spark, text, long, double):
    assert column(spark, [text], casts.to_long) == [long]
    assert column(spark, [text], casts.to_double) == [double]


def test_boolean_cast(spark):
    values = ["TRUE", " y ", "1", "No", "f", "0", "2", "", None, "1.0"]
    assert column(spark, values, casts.to_boolean) == [True, True, True, False, False, False, None, None, None, None]


def test_hash_like_hashlib(spark):
    values = ["77", " 77\t", "　77", "", "  ", None]
    sha = hashlib.sha256(b"pepper:77").hexdigest()
    assert column(spark, values, lambda c: pii.salted_hash(c, "pepper")) == [sha, sha, sha, None, None, None]


def test_dt_forms(spark):
    assert [times.normalize_dt(v) for v in ("20260510", "2026-05-10", " 2026-05-10T01:02:03 ", "2026/05/10", date(2026, 5, 10))] \
        == ["20260510"] * 5
    assert times.dashed_dt("20260510") == "2026-05-10"
    with pytest.raises(ValueError):
        times.normalize_dt("soon")


def test_code_names_and_segments(spark):
    assert column(spark, ["TECH", " FOOD ", "misc", "", None], classify.category_name) == ["테크/가전", "푸드", "misc", None, None]
    tiers = column(spark, [None, 0.0, 29999.0, 30000.0, 99999.0, 100000.0, 300000.0], classify.amount_tier, "double")
    assert tiers == ["unknown", "unknown", "under_30k", "30k_100k", "30k_100k", "100k_300k", "over_300k"]


def test_exact_median_like_statistics(spark):
    rng = random.Random(11)
    groups = {"even": [rng.randint(0, 50) for _ in range(40)], "odd": [rng.random() * 1e9 for _ in range(301)],
              "one": [5.0], "same": [3.0] * 9, "wide": [-1e12, 0.0, 1e-3, 2e-3, 1e12], None: [1.0, 2.0]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("even", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, "g", "v", "m").collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}


def test_dedup_and_split_invariants(spark):
    rng = random.Random(5)
    users = [None, "", "  ", "a", "b", "c"]
    rows = [(rng.choice(users), rng.choice([None, 1, 2]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "user_id_hash string, campaign_id bigint, read_order int").withColumn("dt", F.lit("20260510"))
    kept = keep_last(df, ["user_id_hash", "campaign_id"])
    last = {}
    for u, c, i in rows:
        last[u, c] = i
    assert {(r.user_id_hash, r.campaign_id): r.read_order for r in kept.collect()} == last
    assert keep_last(kept, ["user_id_hash", "campaign_id"]).count() == kept.count()
    valid, errors = split_valid_and_error(kept, get_schema("supporter"))
    assert valid.count() + errors.count() == kept.count()
    assert valid.where("user_id_hash is null or trim(user_id_hash) = '' or campaign_id is null").count() == 0


def test_missing_key_column_fails_every_row(spark):
    df = spark.createDataFrame([("a", "20260510")], "user_id_hash string, dt string")
    valid, errors = split_valid_and_error(df, get_schema("supporter"))
    assert (valid.count(), errors.count()) == (0, 1)


def test_column_lookup_and_filters(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "5", "y")], "Campaign_ID bigint, total_amount_krw string, t string")
    assert present.find_column(df, ["campaign_id"]) == "Campaign_ID"
    assert present.find_column(df, ["nope", "amount"]) == "total_amount_krw"
    assert present.find_column(df, ["zzz"]) is None
    assert present.first_number(df, ["amount"]).first().value == 5.0
    assert present.first_number(df, ["zzz"], 3.0).first().value == 3.0
    assert present.first_value(df, ["t"]).first().value in ("x", "y")
    other = spark.createDataFrame([(1,)], "k int")
    cut = present.for_campaign({"a": df, "b": other}, "2")
    assert cut["a"].count() == 1 and cut["b"].count() == 1
    assert present.for_campaign({"a": df}, None)["a"].count() == 2


def test_word_cloud_cuts_and_order(spark):
    words = [(1, "positive", f"w{i:02d}", 100 - i) for i in range(40)] + [(1, "positive", " w00 ", 1), (1, "positive", "", 50),
             (2, "positive", "rare", 1), (3, "positive", "big", 100), (3, "positive", "small", 17), (3, "positive", "kept", 18)]
    got = present.word_cloud(spark.createDataFrame(words, "campaign_id int, sentiment string, word string, count int")).collect()
    one = sorted((r.place, r.word, r["count"]) for r in got if r.campaign_id == 1)
    ranked = [(f"w{i:02d}", 100 - i + (1 if i == 0 else 0)) for i in range(28)]
    assert [(w, c) for _, w, c in one] == ranked[1::2][::-1] + ranked[::2]
    assert {r.word for r in got if r.campaign_id == 3} == {"big", "kept"} and not [r for r in got if r.campaign_id == 2]
    top = next(r for r in got if r.word == "big")
    assert (top.font_size, top.font_weight, top.opacity) == ("28.0", 850, "0.980")


def test_first_per_group_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 7), (2, None)], "k int, v int")
    got = first_per_group(df, ["k"], [F.desc_nulls_last("v")])
    assert sorted(map(tuple, got.collect())) == [(1, 7), (2, None)]
