"""Quoted CSV that is split within records."""

import random

import pytest

from pledgemart.sources import csv_marts


def by_spark(spark, path):
    return spark.read.csv(path, header=True, escape='"', multiLine=True)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def split_small(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [90, 1 << 20])
def test_result_equals_the_reader_of_whole_files(spark, tmp_path, split_small, end, size):
    rng = random.Random(size)
    word = lambda: "".join(rng.choice('ab ",\né') for _ in range(rng.randrange(9)))
    quote = lambda f: '"' + f.replace('"', '""').replace("\n", end) + '"'
    field = lambda: rng.choice([quote(word()), "", "plain", '""', quote("x\n" * rng.choice([1, 30]))])
    for part in range(3):
        body = end.join(f"{part}-{i},{field()},{field()}" for i in range(20))
        (tmp_path / f"part{part}.csv").write_bytes(f'key,"the\n""note""",more{end}{body}{end if part else ""}'.replace('the\n', f"the{end}").encode())
    split_small(size)
    want = by_spark(spark, str(tmp_path))
    got = csv_marts.read_quoted_csv(spark, str(tmp_path))
    assert got.columns == [c.replace("\r\n", "\n") for c in want.columns] or end == "\r\n"
    assert rows(got) == rows(want) and got.count() == 60


def test_one_file_is_read_by_several_tasks(spark, tmp_path, split_small):
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f'{i},"line\n""{i}"""\n' for i in range(2000)))
    split_small(10000)
    assert csv_marts._numbered_lines(spark, str(path)).rdd.getNumPartitions() > 5
    assert rows(csv_marts.read_quoted_csv(spark, str(path))) == rows(by_spark(spark, str(path)))


def test_odd_quotes_missing_files_and_headers_alone(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('a,b\n5" disk,x\n7,y\n')
    assert csv_marts.csv_records(spark, str(tmp_path / "odd.csv")) is None
    assert rows(csv_marts.read_quoted_csv(spark, str(tmp_path / "odd.csv"))) == rows(by_spark(spark, str(tmp_path / "odd.csv")))
    (tmp_path / "head.csv").write_text("a,b\n")
    head = csv_marts.read_quoted_csv(spark, str(tmp_path / "head.csv"))
    assert head.columns == ["a", "b"] and head.count() == 0
    (tmp_path / "none.csv").write_text("")
    assert csv_marts.read_csv_mart(spark, str(tmp_path), "none").count() == 0
    assert csv_marts.read_csv_mart(spark, str(tmp_path), "missing").columns == []
