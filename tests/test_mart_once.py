"""Figures of a mart that read it several times build it once."""

from pyspark.sql import functions as F

from pledgemart.plans import gold, present

COLUMNS = "campaign_id long, category_name string, total_funding_amount long, achievement_rate double, participation_cnt long, signature_cnt long, positive_comment_cnt long, negative_comment_cnt long, comment_cnt long"
ROWS = [
    (1, "a", 10, 1.0, 5, 2, 1, 0, 4), (2, "a", 30, 2.0, None, 4, 0, 2, 4), (3, None, 7, None, 2, 1, None, None, None),
    (4, "b", None, None, 10, 0, 0, 0, 0), (None, "a", 20, 3.0, 1, 3, 4, 0, 4), (1, "a", 10, 1.0, 5, 2, 1, 0, 4),
]


def counted(spark, columns=COLUMNS, rows=ROWS):
    """A mart, and how many of its rows have been built."""
    built = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    mart = spark.createDataFrame(rows, columns)
    return mart.mapInArrow(run, mart.schema), built


def test_category_summary_builds_the_mart_once(spark):
    mart, built = counted(spark)
    out = present.category_summary(mart).select("category_name", "campaign_cnt", "avg_funding_amount", "avg_positive_rate", "median_funding_amount")
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == {"a": (4, 17.5, 0.375, 15.0), "b": (1, None, None, None)}
    assert built.value == len(ROWS)


def test_category_benchmark_builds_the_mart_once(spark):
    mart, built = counted(spark)
    mart = mart.select("*", F.lit("20240101").alias("dt"), F.lit("t").alias("title"), F.lit(2).cast("bigint").alias("wish_user_cnt"))
    out = gold.campaign_category_benchmark(mart)
    got = sorted(((r.campaign_id, r.category_campaign_cnt, r.category_avg_funding_amount, r.category_median_funding_amount) for r in out.collect()), key=repr)
    assert got == sorted([(1, 2, 17.5, 10.0), (1, 2, 17.5, 10.0), (2, 2, 17.5, 10.0), (4, 1, None, None), (None, 2, 17.5, 10.0)], key=repr)
    assert built.value == len(ROWS)


def test_picker_builds_the_mart_once_and_only_what_it_shows(spark):
    columns = "campaign_id long, title string, maker_name string, status_simplified string, remaining_day long, total_funding_amount long, avg_supporter_backing_amount double"
    rows = [(1, "b", "m", "open", 3, 5, 1.0), (1, "a", "z", "open", 3, 5, 9.0), (1, "a", "n", "open", 3, 5, None), (1, "c", "c", "open", 3, None, 1.0), (None, None, None, None, None, None, None), (2, "x", "y", "open", 3, 6, 0.0)]
    mart, built = counted(spark, columns, rows)
    got = [tuple(r)[:3] for r in present.campaign_picker(mart).collect()]
    assert [r[:2] for r in got] == [(2, "y"), (1, "n"), (None, None)] and got[1][2].startswith("a · 1 · open")
    assert built.value == len(rows)
    # Nothing behind title and maker is asked of the mart.
    lazy = spark.createDataFrame(rows, columns).withColumn("avg_supporter_backing_amount", F.raise_error(F.lit("not shown")).cast("double"))
    assert present.campaign_picker(lazy).count() == 3


def test_performance_index_builds_the_mart_once(spark):
    mart, built = counted(spark)
    bench = spark.createDataFrame([("a", 100.0)], "category_name string, avg_funding_amount double")
    out = present.performance_index(mart, bench).where("metric = 'total_funding_amount'")
    got = [(r["campaign_id"], r["index"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(1, 10.0), (1, 10.0), (2, 30.0), (None, 20.0)], key=repr)
    assert built.value == len(ROWS)
