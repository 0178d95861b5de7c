"""Every query that has an SQL form against it, on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.sources.tables import NAMES
from tools.check import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    problem = compare(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name])
    assert problem is None, problem


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
