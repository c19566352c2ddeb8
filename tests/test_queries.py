import os

import pytest

import __spark_entry__ as driver
from tests.oracle import bag, expected

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
QUERIES = driver.queries()
ORACLES = driver.oracle_sql()

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    names, types, rows = expected(ORACLES[name], SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    assert {n: SPARK_TO_DUCKDB[t] for n, t in df.dtypes} == types
    assert bag(df.columns, df.collect()) == bag(names, rows)


def test_entry(spark):
    assert driver.entry(spark).count() == 1
