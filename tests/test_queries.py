"""Every registered query against its SQL on the given tables."""

import compare
import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return compare.oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    mine = compare.spark_bag(registered.queries()[name](spark, SF))
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert mine[1]
        return
    assert compare.differences(mine, compare.sql_bag(connection, sql)) == ""


def test_entry_returns_rows(spark):
    assert registered.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
