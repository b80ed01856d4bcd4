"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    problem, _ = differences(spark, connection, SF_DIR, queries()[name], oracle_sql()[name])
    assert problem is None


def test_entry(spark):
    assert entry(spark).count() > 0
