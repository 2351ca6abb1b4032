"""Whitening against plain numpy, odd rows, large numbers, several blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, position int, w string, n string"


def plain(rows, k=16):
    """(kept rows as (id, x)), n, deviations, whitened up to sign, explained."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in good]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centre = np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in fit])
    values, unit = np.linalg.eigh(centre.T @ centre / n)
    order = [j for j in np.argsort(values)[::-1][:k] if values[j] > values[-1] * 1e-10]
    dev = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for _, v in x]
    white = np.array([[(n * c - t) / n for c, t in zip(v, s)] for _, v in x]) @ unit[:, order] / np.sqrt(values[order])
    return x, n, dev, white, values[order] / values.sum()


def compare(got, rows):
    x, n, dev, white, explained = plain(rows)
    assert len(got) == len(x) * len(explained)
    by = {}
    for r in got:
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-6
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    ids = {}
    for (i, _), d, w in zip(x, dev, white):
        ids.setdefault((i, d), w)
    assert set(ids) == set(by)
    for j in range(len(explained)):
        a, b = np.array([by[k][j + 1][0] for k in ids]), np.array([ids[k][j] for k in ids])
        sign = np.sign(a @ b)
        assert np.allclose(a, sign * b, atol=1e-6), j


def test_query_matches_numpy(spark, sf):
    got = Q.op12_whitening(spark, sf).collect()
    compare(got, [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()])


def odd():
    rng = np.random.default_rng(3)
    base = [(k, [float(c) for c in rng.normal(size=5) * [5, 3, 2, 1, 0.4]]) for k in range(300)]
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0]), (905, [0.0] * 5)]
    return base, bad


def test_odd_rows_and_copies(spark):
    base, bad = odd()
    rows = base + bad + [(k + 1000, base[0][1]) for k in range(500)] + [(None, base[1][1]), (7, base[7][1])]
    df = spark.createDataFrame([(i, v, 0, 1, "clash", "clash") for i, v in rows] + [(950, [1.0, 2.0], 0, 1, "x", "y")], SCHEMA).repartition(4)
    compare(W.components_long(W.whiten(df)).collect(), rows)


def test_several_blocks_give_the_same(spark, monkeypatch):
    base, _ = odd()
    monkeypatch.setattr(W, "BLOCK_BYTES", 8 * 5 * 16)
    monkeypatch.setattr(W, "COLUMNS", 2)
    monkeypatch.setattr(W, "SPLIT", 3)
    df = spark.createDataFrame([(i, v, 0, 1, "", "") for i, v in base], SCHEMA).repartition(3)
    compare(W.components_long(W.whiten(df)).collect(), base)


def test_no_variance_and_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert W.components_long(W.whiten(none)).count() == 0
    same = spark.createDataFrame([(k, [0.5, 0.25], 0, 1, "", "") for k in range(5)], SCHEMA)
    assert W.components_long(W.whiten(same)).count() == 0
    # A direction that is a multiple of another has no component of its own.
    flat = spark.createDataFrame([(k, [float(k), float(2 * k)], 0, 1, "", "") for k in range(9)], SCHEMA)
    assert W.components_long(W.whiten(flat)).agg(F.max("component")).first()[0] == 1


@pytest.mark.parametrize("size", [1.0, 1e9])
def test_deviation_is_exact_for_large_entries(spark, size):
    rows = [(k, [size * math.sin(k), size * math.cos(3 * k)]) for k in range(40)]
    df = spark.createDataFrame([(i, v, 0, 1, "", "") for i, v in rows], SCHEMA)
    x, n, dev, _, _ = plain(rows)
    got = {r["vec_id"]: int(r["deviation"]) for r in W.whiten(df).collect()}
    assert got == {i: d for (i, _), d in zip(x, dev)}
