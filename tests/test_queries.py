"""Every registered query against its DuckDB SQL, on the smallest tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF_DIR = Path(os.environ.get("TEST_SF_DIR", driver.SMALLEST))

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def values(arrow, columns):
    return sorted([repr(v) for v in row] for row in zip(*[arrow.column(c).to_pylist() for c in columns], strict=True))


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert driver.queries().keys() >= QUERIES.keys()


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, str(SF_DIR)).toArrow()
    theirs = duck.execute(ORACLE[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    assert ours.num_rows > 0
    assert values(ours, columns) == values(theirs, columns)
