"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from jobweft.catalog import equivalent_sql, registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert set(registered()) == set(equivalent_sql())
    assert set(registered()) <= set(contract.queries()) and set(equivalent_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, database, sf_dir, name):
    frame = contract.queries()[name](spark, sf_dir)
    cursor = database.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert as_rows(frame.columns, [tuple(r) for r in frame.collect()]) == as_rows(columns, cursor.fetchall())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and rows[0].active_postings >= rows[-1].active_postings
