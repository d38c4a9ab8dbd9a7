"""Every query against its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, name, FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
    spark.catalog.clearCache()


def test_entry(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
