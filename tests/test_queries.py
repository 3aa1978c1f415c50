"""Every registered query against its SQL in DuckDB, over the whole smallest tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.queries()) >= set(QUERIES) and set(driver.oracle_sql()) <= set(driver.queries())


def check(spark, duck, sf_dir, name):
    frame = driver.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect())
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    want = Counter(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert got == want
    assert sum(got.values()) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    check(spark, duck, sf_dir, name)


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns[:2] == ["seq", "user_id"] and frame.limit(1).count() == 1
