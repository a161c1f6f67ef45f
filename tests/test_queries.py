"""Every registered query against its SQL, at the smallest size."""

import os

import pytest

import __spark_entry__ as driver
from check_queries import compare, sql_session
from toolquarry import queries as library

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    return sql_session(SF_DIR)


def test_every_query_has_sql():
    assert set(library.queries()) == set(library.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
@pytest.mark.parametrize("name", library.queries())
def test_query(spark, sql, name):
    problem, rows = compare(spark, sql, name, SF_DIR)
    assert problem is None
    assert rows


def test_entry(spark):
    assert driver.entry(spark).count()
