"""Landed files: classification, unwrapping, provenance and order."""

import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from pledgemart.sources import landing, seeds

DT = "20260510"


@pytest.fixture
def land(tmp_path):
    def write(name, text, table="preorder", folder=f"dt={DT}/hour=03"):
        path = tmp_path / table / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        data = text if isinstance(text, bytes) else text.encode("utf-8")
        path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        return path

    write.base = str(tmp_path)
    return write


def read(spark, land, table="preorder"):
    records = landing.read_records(spark, land.base, table, DT)
    ordered = records.orderBy("read_order").select(F.to_json("record").alias("r"), "parent", "source_key")
    return [(json.loads(r.r), r.parent, r.source_key.rsplit("/", 1)[-1]) for r in ordered.collect()]


def payloads(spark, land, **how):
    return [r for r, _, _ in read(spark, land, **how)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a":1}', [{"a": 1}]),
        ('[{"a":1},{"a":2}]', [{"a": 1}, {"a": 2}]),
        ('{\n "a": 1,\n "b": [1,\n 2]\n}', [{"a": 1, "b": [1, 2]}]),
        ('[\n {"a":1},\n\n {"a":2}\n]', [{"a": 1}, {"a": 2}]),
        ('{"a":1}\n\n{"a":2}\r\n{"a":3}\n', [{"a": 1}, {"a": 2}, {"a": 3}]),
        ('{"a":1}\n{bad\n{"a":3}', [{"a": 1}, {"a": 3}]),
        ('{bad\n{"a":2}', [{"a": 2}]),
        ('[{"a":1}]\n[{"a":2},{"a":3}]', [{"a": 1}, {"a": 2}, {"a": 3}]),
        ('{"a":1} {"a":2}', []),
        ('{"a":1} trailing', []),
        ('{"a":1', []),
        ("", []),
        (" \n\t ", []),
        ("[1,\"x\",null]", [{"raw_value": 1}, {"raw_value": "x"}, {"raw_value": None}]),
        ("7", [{"raw_value": 7}]),
        ('{"a":1,"a":2}', [{"a": 2}]),
        ('{"campaignId":1,"campaignid":2}', [{"campaignId": 1, "campaignid": 2}]),
        ('{" a ":1,"b ":{"c":2}}', [{"a": 1, "b": {"c": 2}}]),
        ('{"t":"he said \\" x \\": y"}', [{"t": 'he said " x ": y'}]),
        ("[]", []),
    ],
)
def test_payload_shapes(spark, land, text, expected):
    land("part.json", text)
    assert payloads(spark, land) == expected


def test_wrapper_children_get_the_scalars_of_their_parent(spark, land):
    land("a.json", json.dumps({"user_id": 7, "collected_at": "t", "meta": {"x": 1}, "data": [{"p": 1}, 5, {"p": 2}]}))
    got = read(spark, land)
    assert [r for r, _, _ in got] == [{"p": 1}, {"raw_value": 5}, {"p": 2}]
    assert all(parent == {"user_id": "7", "collected_at": "t"} for _, parent, _ in got)


def test_first_wrapper_field_with_a_list_wins(spark, land):
    land("a.json", '{"data":{"k":1},"items":[{"i":1}],"results":[{"r":1}]}')
    assert payloads(spark, land) == [{"i": 1}]


def test_object_data_stays_one_row(spark, land):
    land("a.json", '{"user_id":1,"data":{"userInfo":{"userId":9}}}')
    assert payloads(spark, land) == [{"user_id": 1, "data": {"userInfo": {"userId": 9}}}]


def test_wrappers_in_a_list_are_unwrapped_for_histories_only(spark, land):
    text = '[{"user_id":1,"data":[{"p":1}]},{"user_id":2,"data":[]}]'
    for table in ("fundings", "preorder"):
        land("a.json", text, table=table)
    assert payloads(spark, land, table="fundings") == [{"p": 1}]
    assert payloads(spark, land) == json.loads(text)


def test_both_day_spellings_nested_folders_and_endings(spark, land):
    land("b.json", '{"n":"compact"}')
    land("a.jsonl", '{"n":"dashed"}', folder="dt=2026-05-10/deep/er")
    land("c.json.gz", '{"n":"gzip"}\n{"n":"gzip2"}')
    land("d.txt", '{"n":"ignored"}')
    land("e.json", '{"n":"other day"}', folder="dt=20260511")
    assert [r["n"] for r in payloads(spark, land)] == ["compact", "gzip", "gzip2", "dashed"]


def test_missing_day_is_empty(spark, land):
    assert payloads(spark, land) == []


def test_path_with_special_characters_is_decoded(spark, land):
    land("user_id=a b+c.json", '{"n":1}')
    assert read(spark, land)[0][2] == "user_id=a b+c.json"


def test_invalid_bytes_are_replaced(spark, land):
    land("a.json", b'{"n":"a\xffb"}')
    assert payloads(spark, land) == [{"n": "a�b"}]


@pytest.mark.parametrize("text, expected, parent", [
    ('{"user_id": 1, "data": [\n{"projectId": 1},\n{"projectId": 2}\n]}', [{"projectId": 1}, {"projectId": 2}], {"user_id": "1"}),
    ('[{"projectId": 1},\n{"projectId": 2},\n{"projectId": 3}]', [{"projectId": n} for n in (1, 2, 3)], None),
    ('["12", "x", {"a": 1}]', [{"raw_value": "12"}, {"raw_value": "x"}, {"a": 1}], None),
    ('{"user_id":1,"data":[{"p":1},{"p":2}]}', [{"p": 1}, {"p": 2}], {"user_id": "1"}),
    ('{"a":1}\n{bad\n[{"a":2},\n{"a":3}', [{"a": 1}, {"a": 3}], None),
    ("\n \n[\n{\n\"a\": 1\n}\n]\n", [{"a": 1}], None),
])
@pytest.mark.parametrize("ending", ["json", "jsonl", "json.gz"])
def test_a_file_is_read_alike_whatever_its_ending_and_splits(spark, land, text, expected, parent, ending):
    land(f"a.{ending}", text)
    for most in ("40b", "128m"):  # splits of 40 bytes, and one split
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            got = read(spark, land)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r for r, _, _ in got] == expected
        assert not parent or all(p["user_id"] == parent["user_id"] for _, p, _ in got)


def test_lines_of_one_file_are_split_and_keep_their_order(spark, land):
    lines = [json.dumps({"n": i, "pad": "x" * 50}) for i in range(200)]
    land("a.jsonl", "\n".join(lines[:100] + ["{bad"] + lines[100:]))
    land("b.json", json.dumps([json.loads(x) for x in lines]))
    small = read(spark, land)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert landing.read_files(spark, land.base, "preorder", DT).rdd.getNumPartitions() > 4
        assert read(spark, land) == small and len(small) == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ['{"n": "%s"}' % ("x" * 100), '[\n{"n": "%s"}\n,5' % ("x" * 100), '{"n":1}\n{"n":"%s"}' % ("x" * 100)])
def test_a_document_that_no_variant_can_hold_stops_the_job_with_its_name(spark, land, text):
    land("huge.json", text[:-1])  # unreadable, as one beyond Spark's limit would be
    files = landing.read_files(spark, land.base, "preorder", DT)
    with pytest.raises(Exception, match="above Spark's size limit.*huge.json"):
        landing.parse_documents(files, max_document_bytes=64).collect()


def test_bad_lines_are_counted_per_file(spark, land):
    land("a.jsonl", '{"a":1}\n{bad\nworse\n')
    land("b.jsonl", '{"a":1}')
    got = landing.count_bad_lines(spark, land.base, "preorder", DT).collect()
    assert [(r.source_key.rsplit("/", 1)[-1], r.bad_lines) for r in got] == [("a.jsonl", 2)]


def test_seed_campaign_ids(spark, land):
    land("a.json", '[{"campaignId":"12"},{"campaignId":"x","project_id":7.9},{"title":"none"},5]')
    land("b.json", '{"projectList":[{"raw":{"id":3}},{"raw":"","raw_text":{"id":4}},{"raw":"text","data":{"id":5}}]}')
    land("c.json", '{"id":99}\n{"id":98}')
    land("d.jsonl", '{"id":97}')
    land("e.json", '{"id":96}', folder="dt=2026-05-10")
    ids = lambda **kw: [
        r.campaign_id
        for r in seeds.seed_campaign_ids(
            seeds.seed_rows(seeds.read_payloads(spark, land.base, "preorder", DT, **kw))
        ).collect()
    ]
    assert ids() == [3, 4, 7, 12]


def test_seed_user_ids_order_placeholders_and_cap(spark, land):
    land("a.json", json.dumps([
        {"raw_text": {"encUserId": "b"}, "user_id": "z"},
        {"raw_text": {"encUserId": " None "}, "raw": {"memberId": 5}},
        {"user_id": "NULL", "memberId": "a"},
        {"data": {"userId": ""}},
    ]), table="supporter")
    rows = seeds.seed_rows(seeds.read_payloads(spark, land.base, "supporter", DT))
    assert [r.user_id for r in seeds.seed_user_ids(rows).collect()] == ["5", "a", "b"]
    assert [r.user_id for r in seeds.seed_user_ids(rows, cap=2).collect()] == ["5", "a"]


def test_flatten_comments_handles_missing_and_null_replies(spark):
    pages = spark.createDataFrame(
        [(1, '{"boardId":1,"commentReplys":[{"boardId":2},{"boardId":3}]}'),
         (1, '{"boardId":4,"commentReplys":null}'), (2, '{"boardId":5}')], "campaign_id bigint, c string")
    pages = pages.select("campaign_id", F.parse_json("c").alias("comment"))
    got = seeds.flatten_comments(pages).select(
        "campaign_id", F.try_variant_get("raw", "$.boardId", "int"), "depth", "status").collect()
    assert sorted(tuple(r) for r in got) == [
        (1, 1, 0, "success"), (1, 2, 1, "success"), (1, 3, 1, "success"), (1, 4, 0, "success"), (2, 5, 0, "success")]


def _lines_document(spark, n):
    text = "\n".join('{"a":%d,"b":[1,2]}' % i for i in range(n))
    return landing.parse_documents(landing.with_file_position(spark.createDataFrame([(text, "k")], "text string, source_key string")))


def test_time_grows_with_the_lines_of_a_file_and_not_with_their_square(spark):
    def seconds(n):
        docs = _lines_document(spark, n)
        times = []
        for _ in range(3):
            start = time.perf_counter()
            docs.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return min(times)

    assert _lines_document(spark, 5000).count() == 5000
    seconds(500)  # compiled
    assert seconds(80000) <= 5 * seconds(20000)


def test_behind_the_units_nothing_looks_at_the_text(spark):
    plan = _lines_document(spark, 3)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    assert at and not any(word in line for line in plan[:at] for word in ("text#", "lines#", "RLIKE"))


def test_line_files_are_never_opened_as_wholes(spark, land):
    for i in range(5):
        land(f"lines{i}.json", '{"a":1}\n{bad\n{"a":2}\n')
    land("zip.json.gz", '{"a":3}\n{"a":4}\n')
    land("document.json", '{\n "a": 5\n}')
    files = landing.read_files(spark, land.base, "preorder", DT)
    assert files.count() == 5 * 3 + 2 + 1 and files.where("block_start < 0").count() == 1
    files.collect()
    opened, leaves = {}, files._jdf.queryExecution().executedPlan().collectLeaves()
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        opened[i] = metrics.get("numFiles").get().value()
    assert sorted(opened.values()) == [1, 6]
    assert sorted(r["a"] for r in payloads(spark, land)) == [1] * 5 + [2] * 5 + [3, 4, 5]
