"""Every registered query against its SQL, value by value."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        compare(df, con, SQL[name])
    else:
        assert df.limit(1).count() == 1
