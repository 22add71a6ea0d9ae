"""The registered training-data queries, and those with SQL against DuckDB."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from sheen.llm import queries


def test_all_are_registered():
    names = E.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    got = queries.QUERIES[name](spark, sf)
    want = con.sql(queries.SQL[name]).select(*got.columns)
    rows = [sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in x], key=str)
            for x in (got.collect(), want.fetchall())]
    assert rows[0] == rows[1]
