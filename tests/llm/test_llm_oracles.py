"""Operators on whole tables against DuckDB, with names and sizes that SQL can make too."""

import glob
from pathlib import Path

import duckdb
import pytest

from zonewright.llm import oracle, queries

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, D)
    rel = duck.sql(oracle.oracle_sql()[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) == sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())
