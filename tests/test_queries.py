"""Every named query that has a SQL counterpart gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import DATA
from wordloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    note, rows, *_ = difference(spark, con, name, QUERIES, ORACLES, DATA)
    assert note is None
    assert rows > 0


def test_entry_offers_all():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).columns == ["site", "token", "cnt", "rank"]
