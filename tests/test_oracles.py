"""Every query with SQL gives what DuckDB gives; the others run and have a stable schema."""

import glob
import math
from pathlib import Path

import duckdb
import pytest
from zonewright.plans import catalogue

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 8) + 0.0:.8f}"
    if isinstance(v, (list, tuple)):
        return str([canon(x) for x in v])
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(tuple(map(canon, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(canon(r[i]) for i in at) for r in rel.fetchall())


def test_no_oracle_without_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
