"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from tickvault.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if v is None or v is pd.NA or isinstance(v, float) and v != v else float(v) if isinstance(v, float) else v for v in r) for r in df.astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name]).df()
    have = pd.DataFrame([r.asDict() for r in got.collect()], columns=got.columns)
    assert sorted(got.columns) == sorted(want.columns)
    a, b = normal(have), normal(want)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or (p is None and q is None) or (isinstance(p, (int, float)) and p is not None and q is not None and abs(p - q) <= 1e-9 * max(1, abs(p))) for p, q in zip(x, y)), (x, y)
