"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from folioscope.plans import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations part".split()


@pytest.fixture(scope="module")
def database(sample):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sample}/{name}.parquet'")
    return connection


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sample, database, name):
    found = QUERIES[name](spark, sample)
    wanted = database.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    ours = shown(found.columns, found.collect())
    theirs = shown(wanted.columns, wanted.fetchall())
    assert ours == theirs


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 2500
    assert set(oracle_sql()) <= set(queries())
