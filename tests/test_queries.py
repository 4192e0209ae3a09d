"""Every registered query against its SQL, on the smallest test data."""

import os

import pytest

import __spark_entry__ as registered
from checks.compare import connect, difference

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name not in registered.LLM_SQL}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(registered.queries())
    assert set(registered.queries()) - set(registered.LLM_QUERIES) - set(SQL) == {
        "hier_predict", "hier_scores", "answer_queries",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    found = registered.queries()[name](spark, SF).toPandas()
    assert difference(found, connection.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
