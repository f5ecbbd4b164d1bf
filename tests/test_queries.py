"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert difference(df, connection, oracle_sql()[name]) is None
    else:
        assert df.count() >= 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
