"""Every query against its SQL, on whole tables, value by value."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from comptoir.catalog.oracle import oracle
from comptoir.catalog.queries import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, duck, name):
    frame = queries()[name](spark, SF_DIR)
    columns, rows = canonical(frame.columns, frame.collect())
    checked = duck.sql(oracle_sql()[name])
    expected_columns, expected = canonical(checked.columns, checked.fetchall())
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_every_query_of_the_lake_has_sql():
    assert set(oracle()) == set(REGISTRY)
    assert set(oracle_sql()) <= set(queries())
