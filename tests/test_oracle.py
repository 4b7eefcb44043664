"""Every query with SQL gives the rows that DuckDB gives for it."""

import math
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float):
        return str(int(v)) if v == int(v) and abs(v) < 1e15 else f"{v:.8g}"
    return str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in frame[names].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got, want = rows(QUERIES[name](spark, SF).toPandas()), rows(duck.sql(SQL[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b][:3] == []


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[0]) == len(QUERIES)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
