"""Keyed merges on toy rows, plus properties."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as M

KEYS = ["k1", "k2"]
SCHEMA = "k1 string, k2 int, a string, b double"


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def as_set(d):
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def test_replace_upsert(spark):
    old = df(spark, [("x", 1, "a1", 1.0), ("y", 2, "a2", 2.0)])
    new = df(spark, [("y", 2, None, 9.0), ("z", 3, "a3", 3.0)])
    out = M.replace_upsert(old, new, KEYS)
    assert as_set(out) == [("x", 1, "a1", 1.0), ("y", 2, None, 9.0), ("z", 3, "a3", 3.0)]


def test_replace_upsert_idempotent(spark):
    old = df(spark, [("x", 1, "a1", 1.0), ("y", 2, "a2", 2.0)])
    new = df(spark, [("y", 2, "n", 9.0)])
    once = M.replace_upsert(old, new, KEYS)
    twice = M.replace_upsert(once, new, KEYS)
    assert as_set(once) == as_set(twice)


def test_null_safe_keys(spark):
    old = df(spark, [(None, 1, "old", 1.0), ("y", None, "old", 2.0)])
    new = df(spark, [(None, 1, "new", 5.0)])
    plain = as_set(M.replace_upsert(old, new, KEYS))
    safe = as_set(M.replace_upsert(old, new, KEYS, null_safe=True))
    assert len(plain) == 3  # NULL keys never match with '='
    assert sorted(r[2] for r in safe) == ["new", "old"]


def test_last_write_wins_in_batch(spark):
    batch = df(spark, [("x", 1, "first", 1.0, 1), ("x", 1, "second", None, 2), ("y", 1, "only", 3.0, 1)],
               SCHEMA + ", seq int")
    out = as_set(M.last_write_wins(batch, KEYS, "seq"))
    assert out == [("x", 1, "second", None), ("y", 1, "only", 3.0)]


def test_set_fold_keeps_values_per_column(spark):
    batch = df(spark, [("x", 1, "c", 5.0, 1), ("x", 1, "d", None, 2)], SCHEMA + ", seq int")
    assert as_set(M.set_fold(batch, KEYS, "seq")) == [("x", 1, "d", 5.0)]


def test_set_upsert_never_loses_a_value(spark):
    old = df(spark, [("x", 1, "a1", 1.0), ("y", 2, "a2", 2.0)])
    new = df(spark, [("x", 1, None, 7.0), ("z", 3, "a3", None)])
    out = as_set(M.set_upsert(old, new, KEYS))
    assert out == [("x", 1, "a1", 7.0), ("y", 2, "a2", 2.0), ("z", 3, "a3", None)]


def test_merge_outcomes(spark):
    old = df(spark, [("x", 1, "a", 1.0), ("y", 2, "b", 2.0), ("w", 4, "c", 4.0)])
    new = df(spark, [("x", 1, "a", 1.0), ("y", 2, "b", 3.0), ("z", 3, "n", 0.0)])
    got = {r.action: r.n for r in M.merge_outcomes(old, new, KEYS).collect()}
    assert got == {"unchanged": 1, "updated": 1, "inserted": 1, "untouched": 1}
    new_set = df(spark, [("y", 2, None, 2.0)])
    got = {r.action: r.n for r in M.merge_outcomes(old, new_set, KEYS, mode="set").collect()}
    assert got == {"unchanged": 1, "untouched": 2}


def test_append_duplicates_and_required_keys(spark):
    a = df(spark, [("x", 1, "a", 1.0)])
    both = M.append(a, a)
    assert both.count() == 2
    assert as_set(M.duplicate_keys(both, KEYS)) == [("x", 1, 2)]
    assert M.duplicate_keys(a, KEYS).count() == 0
    holes = df(spark, [("x", None, "a", 1.0), (None, 1, "b", 1.0), ("z", 2, None, None)])
    assert as_set(M.required_keys(holes, KEYS)) == [("z", 2, None, None)]


def test_hot_key_dedup_is_partial_aggregate(spark):
    """A key holding most of the batch is combined map-side (no window)."""
    batch = spark.range(20000).selectExpr("'hot' AS k1", "1 AS k2", "cast(id as string) AS a",
                                          "cast(id as double) AS b", "id AS seq").repartition(8)
    out = M.last_write_wins(batch, KEYS, "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert out.collect()[0].a == "19999"


def test_duplicate_incoming_keys_are_folded(spark):
    old = df(spark, [("x", 1, "a1", 1.0)])
    new = df(spark, [("x", 1, "a2", None), ("x", 1, None, 7.0), ("z", 3, "first", 1.0), ("z", 3, "last", None)]).coalesce(1)
    assert as_set(M.set_upsert(old, new, KEYS)) == [("x", 1, "a2", 7.0), ("z", 3, "last", 1.0)]
    assert as_set(M.replace_upsert(old, new, KEYS)) == [("x", 1, None, 7.0), ("z", 3, "last", None)]
    for mode in ("set", "replace"):
        assert {r.action: r.n for r in M.merge_outcomes(old, new, KEYS, mode).collect()} == {"updated": 1, "inserted": 1}


def test_null_order_is_an_error(spark):
    batch = df(spark, [("x", 1, "a", 1.0, None)], SCHEMA + ", seq int")
    with pytest.raises(Exception, match="order of the batch"):
        M.last_write_wins(batch, KEYS).collect()


def test_merge_ignores_a_stamp(spark):
    old = df(spark, [("x", 1, "a", 1.0), ("y", 1, "b", 1.0)])
    new = df(spark, [("x", 1, "a", 2.0)])
    got = {r.k1: (r.b, r[M.ACTION]) for r in M.merge(old, new, KEYS, ignore=("b",)).collect()}
    assert got == {"x": (2.0, "unchanged"), "y": (1.0, "untouched")}


def test_set_upsert_extra_columns(spark):
    old = df(spark, [("x", 1, "a1", 1.0)])
    new = spark.createDataFrame([("x", 1, "extra"), ("q", 9, "e2")], "k1 string, k2 int, c string")
    for seq in (None, "c"):
        out = {(r.k1, r.k2): r.asDict() for r in M.set_upsert(old, new.withColumn("s", F.lit(1)) if seq else new, KEYS, "s" if seq else None).collect()}
        assert out[("x", 1)] == {"k1": "x", "k2": 1, "a": "a1", "b": 1.0, "c": "extra"}
        assert out[("q", 9)] == {"k1": "q", "k2": 9, "a": None, "b": None, "c": "e2"}
