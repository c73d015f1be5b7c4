"""Every registered query against its SQL equivalent, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from skygauge.suite import EXPECTED_SQL, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def canonical(cell):
    """Numbers alike, whatever their type."""
    if isinstance(cell, bool) or cell is None or isinstance(cell, str):
        return repr(cell)
    number = float(cell)
    return "nan" if math.isnan(number) else repr(number + 0.0)


def table(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in records)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(EXPECTED_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, tables, name):
    found = QUERIES[name](spark, SF_DIR)
    answer = tables.execute(EXPECTED_SQL[name])
    expected = table([c[0] for c in answer.description], answer.fetchall())
    assert table(found.columns, found.collect()) == expected
