"""Every query against its SQL, on whole tables."""

import pytest

from __spark_entry__ import entry
from rillflow.plans.registry import QUERIES
from check import compare, open_tables
from conftest import SF
from oracle import load_sql

SQL = load_sql()


@pytest.fixture(scope="module")
def duck():
    return open_tables(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
