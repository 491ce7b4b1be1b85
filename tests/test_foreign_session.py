"""Queries on a session that the library did not start."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as entry

assert entry.entry(spark).count() == 10
queries = entry.queries()
for name in ("src_seed_user_ids", "fn_formats", "d6_sentiment_share"):
    if name in queries:
        assert queries[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_queries_run_on_a_plain_session(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT)], cwd=tmp_path, capture_output=True, text=True, timeout=600
    )
    assert "all ran" in run.stdout, run.stderr[-2000:]
