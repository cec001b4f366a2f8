import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in SQL:
        assert difference(got, con.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry(spark).columns[:3] == ["split", "lang", "examples"]
