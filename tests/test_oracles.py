"""Every query with SQL gives the same rows as DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from foliospark import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(rows, columns, names):
    at = [columns.index(n) for n in names]
    text = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(round(float(v), 9)) if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cursor = duck.execute(plans.SQL[name])
    columns, rows = [c[0] for c in cursor.description], cursor.fetchall()
    names = sorted(df.columns)
    assert sorted(columns) == names
    assert plain(df.collect(), df.columns, names) == plain(rows, columns, names)
