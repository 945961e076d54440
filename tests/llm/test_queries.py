"""Queries of this package that SQL can express, against DuckDB."""

import pytest

from tests.compare import connect, difference
from tests.conftest import DATA
from wordloom.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    note, rows, *_ = difference(spark, con, name, QUERIES, ORACLES, DATA)
    assert note is None and rows > 0


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
