"""Every query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from trendloom.bindings.oracle import ORACLE
from trendloom.bindings.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, db, name):
    assert difference(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
