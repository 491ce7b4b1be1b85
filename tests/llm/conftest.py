import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def awkward(spark):
    """Nulls, empty and blank texts, repeated rows, equal ids, and extra columns with clashing names."""
    long = " ".join(f"w{i * 7919 % 30011}" for i in range(30000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven twelve", "a"),
        (1, "one two three four five six seven eight nine ten eleven twelve", "a"),
        (2, "One Two three four five six seven eight nine ten eleven TWELVE", None),
        (3, None, None), (4, "", "b"), (5, " \n\t ", "b"), (None, "no id here", "c"), (None, None, None),
        (6, long, "d"), (7, "é ñ 漢字 \U0001f600 ok", "e"), (8, "word", "e"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "cast(length(text) as long) n_chars", "1 as TEXT", "2 as row_key", "3 as fp", "4 as size")
