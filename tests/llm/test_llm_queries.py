"""The operators' queries against their SQL, at the smallest size."""

import os

import pytest

import __spark_entry__ as driver
from check_queries import compare, sql_session
from toolquarry.llm import queries as llm

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    return sql_session(SF_DIR)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.queries())
    assert numbers == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query(spark, sql, name):
    problem, rows = compare(spark, sql, name, SF_DIR)
    assert problem is None
    assert rows
