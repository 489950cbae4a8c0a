"""Every registered query against its SQL on the smallest tables (CHECK_SF_DIR for others)."""

import os

import __spark_entry__ as entry
import pytest
from against import compare, connect

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_sql_is_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, connection, name):
    outcome, _, _ = compare(spark, connection, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert outcome == "ok"
