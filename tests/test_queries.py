"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from check_queries import TABLES, sorted_rows
from workload.tables import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = registry.queries()[name](spark, FOLDER)
    cursor = db.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, cursor.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
