"""Table transforms on hand-written documents."""

import hashlib
import json
from datetime import datetime

import pytest

from pledgemart.plans import silver
from pledgemart.registry import SCHEMAS, get_schema
from pledgemart.sources import landing

DT = "20260510"
SETTINGS = silver.Settings(hash_salt="pepper", processed_at=datetime(2026, 5, 10, 12))


@pytest.fixture
def build(spark):
    def run(table, *documents, key="landing/dt=20260510/hour=03/part.json", **options):
        rows = []
        for i, d in enumerate(documents):
            text, at = d if isinstance(d, tuple) else (d, key.replace("part", f"part{i}") if "part" in key else key)
            rows.append((text if isinstance(text, str) else json.dumps(text), at))
        files = landing.with_file_position(spark.createDataFrame(rows, "text string, source_key string"))
        records = landing.unwrap_records(
            landing.parse_documents(files), unwrap_items=table in ("fundings", "wishes"))
        df = silver.build_table(records, table, DT, options.get("settings", SETTINGS))
        assert df.columns == get_schema(table).columns
        return [r.asDict() for r in df.collect()]

    return run


def sha(value):
    return hashlib.sha256(f"pepper:{value}".encode()).hexdigest()


def test_registry_is_consistent():
    assert len(SCHEMAS) == 7
    for table, schema in SCHEMAS.items():
        assert "dt" in schema.columns and schema.required_keys and schema.dedup_keys
        for key in schema.required_keys + schema.dedup_keys + schema.sort_keys:
            assert key in schema.types, (table, key)
    with pytest.raises(ValueError):
        get_schema("nope")
    with pytest.raises(ValueError):
        silver.load_transform("nope")


def test_preorder(build):
    a, b = sorted(build("preorder", [
        {"campaignId": 1, "title": "A", "categoryCode": "TECH", "totalBackedAmount": 500000, "remainingDay": 3,
         "participationCnt": 12, "collectedAt": "2026-05-10T00:59:59+00:00"},
        {"campaignid": "2", "status": "CLOSED", "remainingday": -1},
    ]), key=lambda r: r["campaign_id"])
    assert (a["campaign_id"], a["title"], a["category_code"], a["category_name"]) == (1, "A", "TECH", "테크/가전")
    assert (a["total_funding_amount"], a["remaining_day"], a["remaining_days_at_snapshot"]) == (500000, 3, 3)
    assert a["snapshot_ts"] == datetime(2026, 5, 10, 9, 59, 59) and a["snapshot_dt"] == "20260510"
    assert a["maker_id"] is None and a["maker_name"] == "" and a["is_adult"] is False and a["dt"] == DT
    assert a["silver_processed_at"] == datetime(2026, 5, 10, 12)
    assert (b["campaign_id"], b["status_simplified"], b["remaining_day"]) == (2, "종료", -1)
    # No time in the record: the hour in the path, in UTC, moved to Korean time.
    assert b["snapshot_ts"] == datetime(2026, 5, 10, 12, 0)
    assert b["category_name"] == "" and b["category_code"] is None


def test_preorder_path_hour_can_reach_the_next_day(build):
    (row,) = build("preorder", {"id": 1}, key="p/dt=20260510/hour=20/part.json")
    assert row["snapshot_ts"] == datetime(2026, 5, 11, 5) and row["snapshot_dt"] == "20260511"
    (row,) = build("preorder", {"id": 1}, key="p/part.json")
    assert row["snapshot_ts"] == datetime(2026, 5, 10, 9)


def test_null_rules_come_before_casts(build):
    rows = build("preorder", [
        {"id": 1, "remainingDay": "abc", "targetAmount": 12.5, "isAdult": "maybe"},
        {"id": 2, "targetAmount": "12.0"}, {"id": 3, "targetAmount": None, "title": None},
    ])
    by = {r["campaign_id"]: r for r in rows}
    assert by[1]["remaining_day"] is None and by[1]["target_amount"] is None and by[1]["is_adult"] is None
    assert by[2]["remaining_day"] == 0 and by[2]["target_amount"] == 12
    assert by[3]["target_amount"] == 0 and by[3]["title"] == ""


def test_empty_text_is_a_value_and_null_is_not(build):
    (row,) = build("preorder", {"id": 1, "title": "", "campaignTitle": "later", "maker_name": None, "makerName": "M"})
    assert row["title"] == "" and row["maker_name"] == "M"


def test_keep_last_follows_read_order(build):
    doc = lambda title: {"id": 1, "title": title, "collectedAt": "2026-05-10T00:00:00Z"}
    (row,) = build("preorder", (doc("b"), "k/b.json"), (doc("a"), "k/a.json"))
    assert row["title"] == "b"
    (row,) = build("preorder", [doc("first"), doc("second")])
    assert row["title"] == "second"
    lines = "\n".join(json.dumps(doc(str(i))) for i in range(12))
    (row,) = build("preorder", lines)
    assert row["title"] == "11"


def test_timestamps_each_on_their_own(build):
    spelled = ["2026-05-10T00:00:00+00:00", "2026-05-10 00:00:00", "2026-05-10T09:00:00+09:00", 1778371200000,
               1778371200, "20260510", "2026/05/10", "2026-05-10"]
    rows = build("preorder", [{"id": i, "whenOpen": t} for i, t in enumerate(spelled)] + [{"id": 99, "whenOpen": "x"}])
    got = {r["campaign_id"]: r["open_ts"] for r in rows}
    assert got.pop(99) is None
    assert set(got.values()) == {datetime(2026, 5, 10, 9)}


def test_comments(build):
    (row,) = build("comments", [{
        "campaign_id": 1, "depth": 0, "status": "success",
        "raw": {"boardId": 11, "body": "<b>배송</b> 언제 되나요?&nbsp;", "whenCreated": "2026-05-10T01:00:00Z",
                "encUserId": "77", "hasReply": True, "maker": False, "owner": False, "support": True}}])
    assert (row["comment_id"], row["campaign_id"], row["depth"]) == ("11", 1, 0)
    assert row["comment_body_cleaned"] == "배송 언제 되나요?" and row["content_length"] == 10
    assert (row["sentiment_label"], row["sentiment_score"], row["keyword_groups"]) == ("negative", -1, "delivery")
    assert row["contains_question_mark"] and row["is_answered"] and row["is_supporter"] and not row["is_maker"]
    assert row["author_id_hash"] == sha("77") and row["comment_date"] == "20260510"
    assert row["time_to_first_answer_min"] is None


def test_comment_keyword_groups_and_ties(build):
    rows = build("comments", [
        {"id": "1", "campaign_id": 1, "body": "기대하고 응원합니다 구매 설치 방법"},
        {"id": "2", "campaign_id": 1, "body": "기대되지만 배송이"},
        {"id": "3", "campaign_id": 1, "body": "문의 드려요"},
        {"id": "4", "campaign_id": 1},
    ])
    by = {r["comment_id"]: r for r in rows}
    assert by["1"]["keyword_groups"] == "expectation,purchase_intent,usage" and by["1"]["sentiment_score"] == 1
    assert by["2"]["sentiment_label"] == "neutral" and by["2"]["keyword_groups"] == "delivery,expectation"
    assert by["3"]["contains_question_mark"] and by["3"]["keyword_groups"] == "usage"
    assert by["4"]["comment_body_cleaned"] == "" and by["4"]["sentiment_label"] == "neutral"
    assert by["4"]["content_length"] == 0 and by["4"]["comment_ts"] is None and by["4"]["comment_date"] is None


def test_supporter_reads_either_container(build):
    rows = build("supporter", [
        {"campaign_id": 1, "raw_text": {"encUserId": "77", "backedAmount": 39000, "type": "PREORDER",
                                        "whenCreated": "2026-05-10T01:00:00Z", "dontShowAmount": False}},
        {"campaign_id": 1, "raw": {"encUserId": 78, "type": "SIGNATURE", "whenCreated": "2026-05-10T01:00:00Z"}},
        {"commonId": "2", "raw_text": {"userInfo": {"userId": 79}}},
    ])
    by = {r["user_id_hash"]: r for r in rows}
    assert by[sha("77")]["is_purchaser"] and not by[sha("77")]["is_signer"]
    assert by[sha("77")]["backing_amount"] == 39000 and by[sha("77")]["raw_support_type"] == "PREORDER"
    assert by[sha("78")]["is_signer"] and not by[sha("78")]["is_purchaser"] and by[sha("78")]["backing_amount"] == 0
    assert by[sha("79")]["campaign_id"] == 2 and by[sha("79")]["supporter_type"] is None
    assert by[sha("79")]["participated_at"] == datetime(2026, 5, 10)


def test_fundings_and_wishes_from_wrapped_lists(build):
    text = [{"collected_at": "2026-05-10T16:00:00+00:00", "user_id": "77", "data": [
        {"projectId": 1, "title": "A", "amount": 39000, "productType": "REWARD", "endYn": 0},
        {"projectId": 2, "amount": "300000", "productType": " Store ", "endYn": "x", "remainingDay": -1}]},
        {"collected_at": "2026-05-10T16:00:00+00:00", "user_id": "78", "data": []}]
    by = {r["campaign_id"]: r for r in build("fundings", text)}
    assert set(by) == {1, 2}
    assert by[1]["user_id_hash"] == sha("77") and by[1]["action_type"] == "funding"
    assert (by[1]["amount_tier"], by[2]["amount_tier"], by[2]["action_type"]) == ("30k_100k", "over_300k", "store")
    assert by[1]["funded_at"] == datetime(2026, 5, 11, 1)
    assert (by[1]["funded_date"], by[1]["funded_hour"], by[1]["funded_dow"]) == ("20260511", 1, 0)
    by = {r["campaign_id"]: r for r in build("wishes", text)}
    assert by[1]["is_active_at_snapshot"] is True and by[2]["is_active_at_snapshot"] is False
    assert by[1]["snapshot_dt"] == by[1]["wish_snapshot_date"] == "20260511"


def test_wish_activity(build):
    rows = build("wishes", {"user_id": 1, "data": [
        {"id": 1, "isEnded": False}, {"id": 2, "isEnded": True}, {"id": 3, "isEnded": "true", "remainingDay": 0},
        {"id": 4}, {"id": 5, "endYn": "1"}]})
    assert {r["campaign_id"]: r["is_active_at_snapshot"] for r in rows} == {
        1: True, 2: False, 3: True, 4: False, 5: False}


def test_user_id_falls_back_to_the_path(build):
    (row,) = build("fundings", {"data": [{"projectId": 1}]}, key="x/user_id=77.json")
    assert row["user_id_hash"] == sha("77") and row["funded_at"] == datetime(2026, 5, 10)
    (row,) = build("fundings", {"data": [{"projectId": 1}]}, key="x/other.json")
    assert row["user_id_hash"] is None


def test_user_info(build):
    rows = build("user_info", [
        {"collected_at": "2026-05-10T02:00:00+00:00", "user_id": "77",
         "data": {"userInfo": {"userId": 77}, "signatureCnt": 3, "totalFundingCount": 4, "followerCnt": 1,
                  "followingCnt": 2, "interestKeyword": ["a", "b", "c"], "isValidJoinedPremiumMembership": True}},
        {"data": {"userInfo": {"userId": 78}, "interestKeyword": "[\"a\",\"b\",\"c\"]"}},
        {"user_id": "79", "data": "text", "interests": "[broken"},
    ])
    by = {r["user_id_hash"]: r for r in rows}
    first = by[sha("77")]
    assert (first["signature_count"], first["total_funding_count"], first["follower_cnt"], first["following_cnt"]) == (3, 4, 1, 2)
    assert first["interest_count"] == 3 and first["is_membership_user"] and first["user_segment"] == "repeat_backer"
    assert by[sha("78")]["interest_count"] == 3 and by[sha("78")]["user_segment"] == "interest_rich_user"
    assert by[sha("78")]["snapshot_dt"] == DT
    assert by[sha("79")]["interest_count"] == 0 and by[sha("79")]["user_segment"] == "light_user"


def test_detail(build):
    (row,) = build("detail", [{"projectId": 5, "title": "T", "status": "success", "collectedAt": "2026-05-10T09:59:59+00:00"}])
    assert row["campaign_id"] == 5 and row["collected_ts"] == datetime(2026, 5, 10, 18, 59, 59)
    assert row["is_error"] is False and row["error_type"] == "" and row["crawl_status"] == "success"


def test_long_ids_keep_every_digit(build):
    (row,) = build("fundings", {"user_id": 123456789012345678, "data": [{"projectId": 9007199254740993}]})
    assert row["campaign_id"] == 9007199254740993 and row["user_id_hash"] == sha("123456789012345678")
