"""Every registered query against its DuckDB restatement (small scale)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import catalog, oracle

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v)
    return str(v)


def _digest(rows):
    return sorted(hashlib.md5(repr(r).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.registry()) == set(oracle.queries_sql())
    assert set(catalog.registry()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.registry()))
def test_query_matches_oracle(spark, sf, con, name):
    sdf = E.queries()[name](spark, sf)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order_s = [sdf.columns.index(c) for c in sorted(sdf.columns)]
    order_d = [rel.columns.index(c) for c in sorted(rel.columns)]
    s = [tuple(_norm(r[i]) for i in order_s) for r in sdf.collect()]
    d = [tuple(_norm(r[i]) for i in order_d) for r in rel.fetchall()]
    assert len(s) == len(d)
    assert _digest(s) == _digest(d)
