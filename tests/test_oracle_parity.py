"""Every registered query against its DuckDB SQL on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from teampulse import oracle

SF = "/root/testdata/sf0.001"
TABLES = ("events", "orders", "lineitem", "supplier")
NAMES = sorted(oracle.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in idx) for r in rel.fetchall()), key=_key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12)
            else:
                assert x == y


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r.impact_rank for r in rows] == sorted(r.impact_rank for r in rows)
