"""Every registered query against its DuckDB oracle SQL on the small tables (the driver's gate, locally)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from voxlake.plans.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """Those of the optional package that SQL cannot express are tested beside it."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order) for r in got), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in exp), key=repr)
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:1] == ["chunk_id"] and df.count() > 0
