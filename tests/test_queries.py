"""Every registered query against its SQL over the small tables."""

import __spark_entry__ as entry
import pytest
from oracle import compare, connect

from conftest import DATA
from tablesync_checks import jdbc

# Queries without SQL, and those of the training-data operators, have tests of their own.
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not name.startswith("op")}
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, connection, name):
    assert compare(spark, connection, DATA, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(jdbc.QUERIES))
def test_jdbc_read(spark, connection, name):
    """Reads of a database that only this process sees: no registered queries, but tests."""
    assert compare(spark, connection, DATA, jdbc.QUERIES[name], jdbc.ORACLE[name]) is None


def test_every_query_has_its_sql():
    assert {n for n in QUERIES if not n.startswith("op") and n != "pipeline"} == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
