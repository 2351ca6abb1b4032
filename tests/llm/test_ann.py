"""Recall and order against brute force."""

import numpy as np

from pyspark.sql import functions as F

from tidemark.llm import ann
from tidemark.llm import queries as Q


def brute(rows, query, k=10):
    """rows: (id, vector) that take part."""
    q = next(v for i, v in rows if i == query)
    d = sorted((float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), i) for i, v in rows if i != query and len(v) == len(q))
    return d[:k]


def test_recall_on_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    rows = [(int(i), np.asarray(v, np.float64)) for i, v in zip(table.vec_id, table.embedding, strict=True)]
    got = Q.op4_ann(spark, sf).toPandas()
    assert set(got.query_id) == {i for i, _ in rows if i % 100 == 0}
    hits = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11)) and q not in set(g.vec_id)
        assert (g.score.diff().dropna() >= 0).all()
        hits += len({i for _, i in brute(rows, q)} & set(g.vec_id))
    assert hits >= 0.95 * len(got)


def test_several_shards(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=12).tolist()) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 30 == 0, shard=200).toPandas()
    hits = sum(len({i for _, i in brute(rows, q)} & set(g.vec_id)) for q, g in got.groupby("query_id"))
    assert len(got) == 300 and hits >= 290


def test_odd_rows_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [0.0, 1.0]), (1, [2.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]),
            (None, [1.0, 0.0]), (200, [1.0, 2.0, 3.0]), (300, [0.0, 0.0]), (2, [0.0, 1.0])]
    rows += [(1000 + 2 * k + 1, [5.0, 5.0]) for k in range(40)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 100}  # 200 has no candidate, 300 takes no part
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and all(np.isfinite(v)) and any(v)]
    for q, found in got.items():
        assert [(d, i) for _, i, d in sorted(found)] == brute(good, q)
    assert ann.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
