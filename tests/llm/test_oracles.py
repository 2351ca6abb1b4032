"""Registered queries of this folder against their DuckDB restatements."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.llm import queries as Q


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(hashlib.md5(repr([repr(r[k]) for k in order]).encode()).hexdigest() for r in rows)


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in Q.registry())
    assert numbers == list(range(1, 14))
    assert set(Q.registry()) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.registry_sql()))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for name_of in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM read_parquet('{sf}/{name_of}.parquet')")
    df = Q.registry()[name](spark, sf)
    rel = con.sql(Q.registry_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())
