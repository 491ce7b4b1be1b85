"""Every query of the daily analytics against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import compare

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for module in entry.MODULES for name, query in module.QUERIES.items()}
ORACLES = entry.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and len(df.columns) == 42
