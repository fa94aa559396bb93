"""Every query against its SQL on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as registry
import check
from nodeledger.registry import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in check.TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, db, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    assert check.difference(ours, db.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert registry.entry(spark).count() == 25
