"""Every registered query against its SQL, on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES = {name: query for name, query in entry_points.queries().items() if name not in entry_points.LLM}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name not in entry_points.LLM}


@pytest.fixture(scope="module")
def oracle(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return tuple(value) if isinstance(value, list) else value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, data, oracle, name):
    got = QUERIES[name](spark, data)
    want = oracle.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = rows_by_name(columns, want.fetchall())
    assert rows_by_name(got.columns, got.collect()) == expected
    assert expected


def test_entry(spark):
    found = {row["queue"]: row["n"] for row in entry_points.entry(spark).collect()}
    assert found == {"gamma": 500, "hadron": 500}
