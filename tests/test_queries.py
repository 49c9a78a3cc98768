"""Every named query against the same question in SQL on another engine."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from millrace.plans.registry import load
from millrace.plans.shop import with_views
from tests.conftest import DATA
from tools.check import compare, connect

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(load()))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, name, queries()[name], SQL[name], DATA) is None


def test_entry_returns_every_product_with_usable_events(spark, connection):
    sql = with_views("select count(distinct product_id) from silver")
    assert entry(spark).count() == connection.execute(sql).fetchall()[0][0]
