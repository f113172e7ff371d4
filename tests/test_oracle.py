"""Every catalog query against its DuckDB twin on the sf0.01 tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from eventide.plans import catalog, oracle

SF = "/root/testdata/sf0.01"
QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6) + 0.0
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    rows = canonical(result.columns, [tuple(r) for r in result.collect()])
    assert rows
    assert rows == canonical(names, expected.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
