"""The operators that SQL can express, against it, on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, data, name):
    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, data)
    assert sorted(got.columns) == sorted(columns)
    expected = Counter(map(tuple, want.fetchall()))
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == expected


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in QUERIES if name.startswith("op")] == [f"op{n}" for n in range(1, 14)]
