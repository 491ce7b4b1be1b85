"""Partials of few users among many."""

import random

from pyspark.sql import functions as F

from pledgemart.operators.partials import number_users
from pledgemart.plans import gold


def test_few_of_many_users_take_few_bytes(spark):
    rng = random.Random(3)
    users = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("user_id_hash"))
    numbers = number_users(users)
    picked = spark.createDataFrame([(str(rng.randrange(50)), "20240101", rng.randrange(200_000), 1) for _ in range(500)], "campaign_id string, dt string, u long, amount long")
    rows = picked.withColumn("user_id_hash", F.sha2(F.col("u").cast("string"), 256))
    partials = gold.funding_partials(rows, numbers)
    assert {t for _, t in partials.dtypes} <= {"string", "bigint"} and partials.count() <= 500
    key = lambda df: sorted(map(tuple, df.select("campaign_id", "funding_user_cnt", "user_history_funding_amount").collect()))
    assert key(gold.merged_funding_totals(partials)) == key(gold.funding_totals(rows))
