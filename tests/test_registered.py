import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, canonical

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


OWN = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_its_sql():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, db, name):
    ours = entry.queries()[name](spark, SF_DIR).toPandas()
    theirs = db.sql(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    assert canonical(ours) == canonical(theirs)
