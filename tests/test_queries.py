"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, name, SF) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
