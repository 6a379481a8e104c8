"""Every registered query against its SQL on the smallest given tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", [n for n in queries() if n in SQL])
def test_matches_sql(spark, con, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert difference(got, con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in SQL])
def test_runs(spark, name):
    assert len(queries()[name](spark, FOLDER).toPandas()) > 0


def test_entry(spark):
    frame = entry(spark)
    assert len(frame.columns) == 125
    assert frame.count() > 0
