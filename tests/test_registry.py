"""Every registered query against its SQL, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for table in ("events", "documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    found = [tuple(r) for r in result.collect()]
    assert found
    if name in ORACLES:
        cursor = db.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(result.columns)
        assert normal(found, result.columns) == normal(cursor.fetchall(), columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "p99" in result.columns
