"""Users take few bytes in joins and shuffles."""

from pyspark.sql import functions as F

from pledgemart.functions.pii import packed, unpacked
from pledgemart.queries import views


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_packed_users_are_equal_only_if_the_texts_are(spark):
    digits = "0123456789abcdef" * 4
    texts = ["", "u1", digits, digits.upper(), digits[:-1], digits + "0", "g" * 64, "a" * 32, "\u00e9" * 64, "x" * 31 + "\0", "x" * 31, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"), unpacked(packed(F.col("t"))).alias("back")).collect()
    assert all(r.t == r.back for r in got) and len({r.p and bytes(r.p) if r.p is not None else None for r in got}) == len(texts)
    assert {len(r.p) for r in got if r.t == digits} == {32}


def test_orders_are_hashed_after_their_join(spark):
    lines = plan(views.supporter(spark, "/root/testdata/sf0.001").select("user_id_hash", "campaign_id")).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("sha2" in line for line in lines[join:])
