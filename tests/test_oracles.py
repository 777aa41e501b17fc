"""Every registered query against its DuckDB oracle (small scale factor)."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from warcsift.plans import registry

TABLES = ("pages", "documents", "embeddings")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _bag(df.columns, srows) == _bag(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.QUERIES) <= set(E.queries())
    assert os.path.isdir(SF001)
