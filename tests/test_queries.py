"""Every registered query against its SQL, on the smallest of the given scales."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, db, name):
    assert difference(spark, db, queries()[name], oracle_sql()[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
