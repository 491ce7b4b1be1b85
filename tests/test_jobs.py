"""Jobs and sinks on folders."""

import csv
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pledgemart import sinks
from pledgemart.operators.quality import assert_public
from pledgemart.plans import gold, jobs, present
from pledgemart.sources import csv_marts, landing

DT = "20260510"


@pytest.fixture
def lake(tmp_path):
    class Lake:
        landing_base, silver_base = str(tmp_path / "landing"), str(tmp_path / "silver")
        error_base, gold_base, export_base = (str(tmp_path / n) for n in ("errors", "gold", "export"))

        def land(self, table, name, payload, dt=DT):
            path = tmp_path / "landing" / table / f"dt={dt}" / "hour=03" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(payload if isinstance(payload, str) else json.dumps(payload), encoding="utf-8")
            return path

        def run(self, spark, table, dt=DT, **options):
            return jobs.run_silver(
                spark, table=table, dt=dt, landing_base=self.landing_base, silver_base=self.silver_base,
                error_base=self.error_base, hash_salt="s",
                processed_at=datetime(2026, 5, 10, 12), **options)

    return Lake()


def supporters(*users):
    return [{"campaign_id": 1, "raw_text": {"encUserId": u, "type": "PREORDER", "backedAmount": 100}} for u in users]


def test_run_silver_splits_writes_and_repeats(spark, lake, rows):
    lake.land("supporter", "a.json", supporters("1", "2", "", None, "1"))
    run = lake.run(spark, "supporter", "2026-05-10")
    assert run.exit_code == 0 and run.dt == DT
    m = run.metrics
    assert (m["read_rows"], m["input_rows"], m["valid_rows"], m["error_rows"]) == (5, 3, 2, 1)
    assert (m["duplicate_rows"], m["keyless_rows_before_dedup"], m["null_user_id_hash"]) == (2, 2, 1)
    table = sinks.read_partitioned(spark, lake.silver_base, "supporter")
    first = rows(table)
    assert len(first) == 2 and {r.dt for r in table.collect()} == {DT}
    errors = spark.read.parquet(run.error_path)
    assert [r["_silver_error_reason"] for r in errors.collect()] == ["missing_required_key"]
    lake.run(spark, "supporter")
    assert rows(sinks.read_partitioned(spark, lake.silver_base, "supporter")) == first


def test_rerun_replaces_only_its_day_and_clears_old_errors(spark, lake):
    lake.land("supporter", "a.json", supporters("1", None))
    lake.land("supporter", "a.json", supporters("9"), dt="20260511")
    lake.run(spark, "supporter")
    lake.run(spark, "supporter", "20260511")
    lake.land("supporter", "a.json", supporters("2", "3"))
    run = lake.run(spark, "supporter")
    table = sinks.read_partitioned(spark, lake.silver_base, "supporter")
    assert dict(table.groupBy("dt").count().collect()) == {DT: 2, "20260511": 1}
    assert spark.read.parquet(run.error_path).count() == 0


def test_empty_input_and_dry_run_leave_outputs_alone(spark, lake, tmp_path):
    assert lake.run(spark, "supporter").exit_code == jobs.EMPTY_INPUT
    lake.land("supporter", "a.json", supporters("1"))
    run = lake.run(spark, "supporter", dry_run=True)
    assert run.exit_code == 0 and run.metrics["valid_rows"] == 1 and run.output_path is None
    assert not (tmp_path / "silver").exists()
    run = lake.run(spark, "supporter", write_errors=False)
    assert run.error_path is None and not (tmp_path / "errors").exists()


def test_allowed_empty_input_empties_the_day(spark, lake):
    path = lake.land("supporter", "a.json", supporters("1"))
    lake.run(spark, "supporter")
    path.write_text("")
    assert lake.run(spark, "supporter", allow_empty=True).exit_code == 0
    assert sinks.read_partitioned(spark, lake.silver_base, "supporter").count() == 0


def test_intermediate_tables_are_removed(spark, lake, tmp_path):
    folder = jobs.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    lake.land("supporter", "a.json", supporters("1"))
    lake.run(spark, "supporter")
    import os
    assert not [n for n in (os.listdir(folder) if os.path.exists(folder) else []) if n.startswith("silver-")]


def test_sorted_within_files(spark, lake):
    lake.land("supporter", "a.json", [
        {"campaign_id": c, "raw_text": {"encUserId": str(c)}} for c in (5, 3, 9, 1, 7)])
    run = lake.run(spark, "supporter")
    for file in spark.read.parquet(run.output_path).inputFiles():
        ids = [r.campaign_id for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)


@pytest.fixture
def filled(spark, lake):
    for dt, amount in (("20260510", 100), ("20260511", 150)):
        at = f"{dt[:4]}-{dt[4:6]}-{dt[6:]}T01:00:00Z"
        lake.land("preorder", "a.json", [
            {"campaignId": 1, "makerId": 5, "title": "A", "makerName": "M", "categoryName": "c", "collectedAt": at,
             "totalBackedAmount": amount, "participationCnt": amount // 10, "signatureCnt": 4, "remainingDay": 0,
             "targetAmount": 1000},
            {"campaignId": 2, "title": "B", "categoryName": "c", "collectedAt": at, "totalBackedAmount": 300,
             "remainingDay": 3},
        ], dt=dt)
        lake.land("supporter", "a.json", supporters("1", "2"), dt=dt)
        lake.land("wishes", "a.json", [{"user_id": "1", "collected_at": at, "data": [{"projectId": 1}]}], dt=dt)
        lake.land("fundings", "a.json", [
            {"user_id": "1", "collected_at": at, "data": [{"projectId": 1, "amount": 70}]}], dt=dt)
        lake.land("comments", "a.json", [
            {"campaign_id": 1, "depth": 0, "raw": {"boardId": 1, "body": "배송 언제 되나요? 환불", "hasReply": True}},
            {"campaign_id": 1, "depth": 1, "raw": {"boardId": 2, "body": "기대 응원", "maker": True}}], dt=dt)
        for table in ("preorder", "supporter", "wishes", "fundings", "comments"):
            assert lake.run(spark, table, dt).exit_code == 0
    return lake


def test_gold_views_and_export(spark, filled, tmp_path):
    silver = lambda table: sinks.read_partitioned(spark, filled.silver_base, table)
    paths = jobs.run_gold(spark, silver=silver, gold_base=filled.gold_base, database="marts")
    assert list(paths) == [
        "campaign_kpi", "campaign_daily_kpi", "campaign_conversion_kpi", "comment_nlp_kpi",
        "campaign_response_performance", "campaign_category_benchmark"]
    kpi = {r.campaign_id: r for r in spark.read.parquet(paths["campaign_kpi"]).collect()}
    one = kpi[1]
    assert (one.dt, one.total_funding_amount, one.remaining_day_label) == ("20260511", 150, "D-day")
    # Distinct users once, sums over every collected day.
    assert (one.supporter_user_cnt, one.purchaser_cnt, one.supporter_backing_amount) == (2, 2, 400)
    assert (one.arppu, one.avg_supporter_backing_amount, one.wish_user_cnt) == (200.0, 100.0, 1)
    assert (one.comment_cnt, one.question_cnt, one.answer_cnt) == (2, 2, 2)
    assert (one.positive_comment_cnt, one.negative_comment_cnt, one.reaction_cnt) == (2, 2, 7)
    assert kpi[2].arppu is None and kpi[2].supporter_user_cnt == 0 and kpi[2].remaining_day_label == "D-3"

    daily = {(r.campaign_id, r.dt): r for r in spark.table("marts.campaign_daily_kpi").collect()}
    assert daily[1, "20260511"].funding_amount_dod == 50 and daily[1, "20260511"].funding_amount_dod_rate == 0.5
    assert daily[1, "20260510"].funding_amount_dod is None and daily[2, "20260511"].participation_dod_rate is None

    nlp = spark.table("marts.comment_nlp_kpi").where("campaign_id = 1 and dt = '20260510'")
    assert {r.keyword_group: r.comment_cnt for r in nlp.collect()} == {
        "delivery": 1, "refund_cancel": 1, "expectation": 1}
    response = spark.table("marts.campaign_response_performance").where("dt = '20260510'").first()
    assert (response.question_cnt, response.answered_question_cnt, response.answer_rate) == (1, 1, 1.0)
    conversion = spark.table("marts.campaign_conversion_kpi").where("campaign_id = 1").first()
    assert (conversion.funding_user_cnt, conversion.user_history_funding_amount) == (1, 140)
    benchmark = spark.table("marts.campaign_category_benchmark").where("campaign_id = 1").first()
    assert (benchmark.category_campaign_cnt, benchmark.category_avg_funding_amount) == (2, 225.0)

    public = spark.table("marts.campaign_kpi_public")
    assert "maker_id" not in public.columns and len(public.columns) == 41
    # A rebuild over the same input changes nothing.
    before = sorted(map(tuple, spark.table("marts.campaign_kpi").collect()), key=repr)
    jobs.run_gold(spark, silver=silver, gold_base=filled.gold_base, database="marts")
    assert sorted(map(tuple, spark.table("marts.campaign_kpi").collect()), key=repr) == before

    out = jobs.run_export(spark, gold_base=filled.gold_base, export_base=filled.export_base)
    text = spark.read.csv(out["campaign_kpi"], header=True)
    assert text.columns == public.columns and text.count() == 2
    files = list((tmp_path / "export" / "campaign_kpi").glob("*.csv"))
    cells = [row for f in files for row in csv.DictReader(f.open(encoding="utf-8"))]
    assert {c["campaign_id"]: c["arppu"] for c in cells} == {"1": "200.0", "2": ""}
    one_campaign = sinks.export_campaign(spark.table("marts.campaign_kpi_public"), "2", str(tmp_path / "one"))
    assert [r.title for r in spark.read.csv(one_campaign, header=True).collect()] == ["B"]

    early = gold.campaign_kpi(*[silver(t) for t in ("preorder", "supporter", "wishes", "comments")], as_of_dt="20260510")
    assert {r.total_funding_amount for r in early.collect()} == {100, 300}


def test_register_and_repair(spark, filled):
    sinks.register_daily_table(spark, "daily", filled.silver_base, "supporter")
    assert spark.table("daily.supporter").count() == 4
    filled.land("supporter", "a.json", supporters("7"), dt="20260512")
    filled.run(spark, "supporter", "20260512")
    sinks.register_daily_table(spark, "daily", filled.silver_base, "supporter")
    assert spark.table("daily.supporter").where("dt = '20260512'").count() == 1


def test_public_guard(spark):
    with pytest.raises(ValueError):
        assert_public(spark.createDataFrame([], "campaign_id bigint, user_id_hash string"))


def test_land_records_round_trip(spark, tmp_path):
    df = spark.range(25).select(F.col("id").alias("campaignId"))
    sinks.land_records(df.coalesce(1), str(tmp_path), "preorder", DT, "07", rows_per_file=10)
    files = list(tmp_path.glob("preorder/dt=20260510/hour=07/*.json"))
    assert len(files) == 3
    assert landing.read_records(spark, str(tmp_path), "preorder", DT).count() == 25


def test_csv_marts(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        ' project_id ,title,dt,collected_at,end_date\n1,"a, ""b""",20260510,2026-05-10T09:59:59+00:00,2026-05-01\n'
        "2,c,20260511,bad,20260502\n3,d,x2026051,,\n", encoding="utf-8")
    df = csv_marts.read_csv_mart(spark, str(tmp_path), "t")
    assert df.columns == ["project_id", "title", "dt", "collected_at", "end_date"]
    got = {r.project_id: r for r in df.collect()}
    assert got["1"].title == 'a, "b"' and got["1"].collected_at.hour == 9 and got["2"].collected_at is None
    assert got["1"].end_date.date() == date(2026, 5, 1) and got["2"].end_date.date() == date(2026, 5, 2)
    assert df.schema["dt"].dataType.typeName() == "timestamp_ntz"
    empty = csv_marts.read_csv_mart(spark, str(tmp_path), "absent")
    assert empty.columns == [] and present.find_column(empty, ["dt"]) is None


def test_compact_dates_need_a_clear_majority(spark):
    df = spark.createDataFrame([("20260510",)] * 9 + [("2026-05-10",)], "dt string")
    got = csv_marts.coerce_dates(df).groupBy("dt").count().collect()
    assert sorted((str(r.dt), r["count"]) for r in got) == [("2026-05-10 00:00:00", 9), ("None", 1)]
