import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", queries())
def test_query(spark, connection, name):
    df = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, connection, sql) == ""


def test_every_statement_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["userId", "rank", "productId", "rating"]
    assert df.count() == 1500
