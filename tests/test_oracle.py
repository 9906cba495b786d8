"""Every registered query against its SQL on the whole sample tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def normal(columns, rows):
    """Rows in column-name order, sorted; numbers stay exact."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(driver.QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    df = driver.queries()[name](spark, FOLDER)
    cursor = database.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = normal(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    found = normal(df.columns, [tuple(r) for r in df.collect()])
    assert len(found) == len(expected) > 0
    wrong = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    assert not wrong, (len(wrong), wrong[:3])
