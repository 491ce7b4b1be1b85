import zlib

import pytest

from pledgemart.llm import kd_shards


def check(docs, shards, slack):
    out = kd_shards.assign(docs, shards=shards).collect()
    place = docs.columns.index("text")
    raw = [(r[0], (r[place] or "").encode()) for r in docs.collect()]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == sorted(((d, len(t) + 16, zlib.crc32(t)) for d, t in raw), key=repr)
    by = {}
    for r in out:
        assert 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    mean, most = sum(r.size for r in out) / shards, max((r.size for r in out), default=0)
    for shard in range(shards):
        assert abs(sum(r.size for r in by.get(shard, ())) - mean) <= slack * most + mean / 100
    return by


def test_bytes_are_nearly_equal(spark, documents):
    check(documents, 7, 2)
    check(documents.union(documents).union(documents.limit(20)), 5, 2)


def test_hot_values_and_equal_rows_are_split(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) doc_id", "if(id % 3 = 0, 'same', concat('text ', id)) text", "'one' source", "cast(null as string) lang")
    by = check(docs, 8, 2)
    assert all(300 < len(rows) < 450 for rows in by.values())


def test_boxes_of_leaves_do_not_mix(spark):
    """With one dimension that varies, the shards are runs of it."""
    docs = spark.range(800).selectExpr("0L doc_id", "'aaaa' text", "concat(char(97 + id div 100), 'x') source")
    by = check(docs, 8, 1)
    assert len(by) == 8


def test_target_bytes_and_odd_rows(spark, awkward, documents):
    assert kd_shards.assign(documents, target_bytes=50_000).select("shard").distinct().count() >= 9
    assert kd_shards.assign(awkward, shards=3).count() == awkward.count()
    assert kd_shards.assign(documents.limit(0), shards=4).count() == 0
    assert kd_shards.assign(documents.limit(0), target_bytes=4).count() == 0


@pytest.mark.parametrize("name", ["source", "lang"])
def test_texts_with_a_long_common_prefix_are_split(spark, name):
    """The shard of every row is that of its source (or language) alone; the first of them is null."""
    other = {"source": "lang", "lang": "source"}[name]
    value = "if(k = 0, null, concat('https://crawl.example.org/2026/', k))"
    docs = spark.range(800).selectExpr("id * 37 % 8 k").selectExpr("0L doc_id", "repeat(k, 4) text", f"{value} {name}", f"'x' {other}")
    by = check(docs, 8, 1)
    crcs = [zlib.crc32(str(k).encode() * 4) for k in range(8)]
    assert [{r.text_crc32 for r in by[i]} for i in range(8)] == [{c} for c in crcs]


def test_many_texts_are_placed_in_order(spark):
    rows = spark.range(500).selectExpr("if(id = 7, null, lpad(id, 40, 's')) source", "id % 5 + 1 size")
    got = sorted(kd_shards._text_places(rows, "source").collect(), key=lambda r: (r.source_text is not None, r.source_text or ""))
    want, total = 0, sum(i % 5 + 1 for i in range(500))
    sizes = {(None if i == 7 else str(i).rjust(40, "s")): i % 5 + 1 for i in range(500)}
    for r in got:
        assert abs(r.place - (want + sizes[r.source_text] / 2) / total) < 1e-12
        want += sizes[r.source_text]


def test_equals_brute_force(spark, monkeypatch):
    """The tree built by hand over the same keys, with cuts as near as whole rows allow."""
    monkeypatch.setattr(kd_shards, "TOLERANCE", 0)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    keys = kd_shards._keys(kd_shards._placed(kd_shards.stage(kd_shards.metadata(docs)))).collect()
    want = {}

    def split(rows, first, shards):
        if shards == 1:
            want.update((r.doc_id, first) for r in rows)
            return
        total = sum(r["size"] for r in rows)

        def spread(d):
            x = [((r[f"k_{d}"] >> kd_shards.TIE_BITS) / (1 << kd_shards.DIM_BITS), r["size"]) for r in rows]
            return sum(w * v * v for v, w in x) / total - (sum(w * v for v, w in x) / total) ** 2

        widest = max(kd_shards.DIMENSIONS, key=spread)
        rows = sorted(rows, key=lambda r: r[f"k_{widest}"])
        share, below, n = total * (shards // 2) / shards, 0, 0
        while n < len(rows) and below + rows[n]["size"] <= share:
            below, n = below + rows[n]["size"], n + 1
        if n < len(rows) and share - below > below + rows[n]["size"] - share:
            n += 1
        split(rows[:n], first, shards // 2)
        split(rows[n:], first + shards // 2, shards - shards // 2)

    split(keys, 0, 7)
    assert {r.doc_id: r.shard for r in kd_shards.assign(docs, shards=7).collect()} == want


def test_ids_that_are_no_numbers_and_many_shards(spark):
    docs = spark.range(3000).selectExpr("concat('d', id) AS doc_id", "repeat('x', 20) AS text")
    out = kd_shards.assign(docs, shards=1000).groupBy("shard").count().collect()
    assert len(out) == 1000 and max(r["count"] for r in out) <= 4
