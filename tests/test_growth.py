"""Sorted rows and the sizes of tasks keep in step with the input."""

from pyspark.sql import functions as F

from pledgemart import session
from pledgemart.operators.dedup import first_per_group


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ties_are_settled_without_a_copy_of_the_row(spark):
    rows = spark.createDataFrame([(1, 5, "b", None), (1, 5, "a", 2.0), (1, 5, "a", None), (2, None, None, 1.0)], "k int, t int, s string, v double")
    first = first_per_group(rows, ["k"], [F.desc_nulls_last("t")])
    assert sorted(map(tuple, first.collect())) == [(1, 5, "a", None), (2, None, None, 1.0)]
    assert "struct(" not in plan(first)


def test_sizes_are_lowered_and_smaller_ones_kept(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    for given, held in (("64MB", 16 << 20), ("67108864b", 16 << 20), ("8m", 8 << 20), ("1g", 16 << 20)):
        spark.conf.set(key, given)
        session.configure(spark)
        assert session._bytes(spark.conf.get(key)) == held
    spark.conf.set(key, before)
    assert session.configure(spark).conf.get(session.INITIAL_PARTITIONS) == str(session.LEAST_PARTITIONS)
