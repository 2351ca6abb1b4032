"""Exact sums: correctly rounded, the same in any order, mergeable."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exact as X


def sums(df):
    """k -> the sum of v, once in one step and once by merging states of random parts."""
    direct = X.with_sums(df.groupBy("k").agg(X.sum_state("v").alias("s")), {"s": "total"})
    parts = df.groupBy("k", (F.rand(7) * 5).cast("int").alias("part")).agg(X.sum_state("v").alias("s"))
    merged = parts.groupBy("k", (F.col("part") % 2).alias("half")).agg(X.merge_states("s").alias("s")).groupBy("k").agg(X.merge_states("s").alias("s"))
    a = {r[0]: r[1] for r in direct.collect()}
    b = {r[0]: r[1] for r in X.with_sums(merged, {"s": "total"}).collect()}
    assert repr(a) == repr({k: b[k] for k in a})
    return a


def cases():
    rng = random.Random(4)
    yield "prices", [round(rng.uniform(900, 105_000), 2) for _ in range(3000)]
    yield "cancel", [6e10, 1.0, -6e10, 2.0 ** -40, 3.5] * 7 + [2.0 ** -70]
    yield "negative", [-rng.uniform(0, 1e9) for _ in range(999)]
    yield "mixed", [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-3, 11) for _ in range(2500)]
    yield "tenths", [0.1] * 1001
    yield "ties", [2.0 ** 35] * (1 << 10) + [2.0 ** -7, 2.0 ** -8]
    yield "half", [2.0 ** 35] * 8 + [2.0 ** -15, 2.0 ** -60]
    yield "minus half", [-(2.0 ** 35)] * 8 + [-(2.0 ** -15), -(2.0 ** -60)]
    yield "down", [-(2.0 ** 35)] * 8 + [-(2.0 ** -15), 2.0 ** -60]
    yield "tiny", [1.2345e-3 * rng.random() + 2.0 ** -20 for _ in range(500)]
    yield "large", [2.0 ** 35.9, -(2.0 ** 30), 2.0 ** 35 + 2.0 ** -17, 1.0] * 500 + [2.0 ** -40]
    yield "zero", [0.0, -0.0, 5.0, -5.0]
    yield "one", [-3.75]
    yield "minus tiny", [-(2.0 ** -19) - 2.0 ** -71, 2.0 ** -19]
    yield "long", [2.0 ** 35.99] * 40_000 + [2.0 ** -30] * 3


def test_sums_are_rounded_once(spark):
    every = dict(cases())
    rows = [(k, v) for k, vs in every.items() for v in vs]
    random.Random(1).shuffle(rows)
    got = sums(spark.createDataFrame(rows, "k string, v double").repartition(5))
    for k, vs in every.items():
        want = float(sum(map(Fraction, vs)))
        assert got[k] == want, (k, got[k], want)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_bits_in_any_order(spark, ansi):
    rng = random.Random(8)
    rows = [(rng.randrange(20), rng.uniform(-1, 1) * 10.0 ** rng.randrange(-8, 11)) for _ in range(4000)]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = set()
        for seed in range(3):
            random.Random(seed).shuffle(rows)
            found.add(repr(sorted(sums(spark.createDataFrame(rows, "k int, v double").repartition(seed + 1)).items())))
        assert len(found) == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_nulls_empty_groups_and_wide_values(spark):
    rows = [("none", None), ("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.0), ("both", math.inf), ("both", -math.inf), ("wide", 1e300), ("wide", 5.0), ("some", None), ("some", 4.0), ("some", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    states = df.groupBy("k").agg(X.sum_state("v").alias("s"))
    got = {r[0]: (r[1], r[2]) for r in X.with_sums(states.withColumn("t", F.col("s")), {"s": "total", "t": "twice"}).collect()}
    assert got["none"] == (None, None) and got["some"] == (9.0, 9.0) and got["wide"][0] == 1e300 and got["inf"][0] == math.inf
    assert math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
    mean = {r[0]: r[1] for r in X.with_sums(states, {"s": "mean"}, averages=True).collect()}
    assert mean["some"] == 4.5 and mean["none"] is None
    assert X.with_sums(df.limit(0).groupBy("k").agg(X.sum_state("v").alias("s")), {"s": "total"}).count() == 0


def test_limbs_of_many_values_carry_over(spark):
    """Merged limbs stay small however large the sums they come from."""
    df = spark.range(2000).select(F.lit(1).alias("k"), (F.lit(2.0 ** 29) + F.lit(0.75) + F.lit(2.0 ** -20)).alias("v"), (F.col("id") % 40).alias("part"))
    states = df.groupBy("k", "part").agg(X.sum_state("v").alias("s"))
    # As if every part held a hundred million such rows.
    grown = states.select("k", F.struct(*[(F.col("s")[c] * (1 << 21)).alias(c) for c in X.LIMB_NAMES], F.col("s.wide").alias("wide"), F.col("s.n").alias("n")).alias("s"))
    once = grown.groupBy("k").agg(X.merge_states("s").alias("s"))
    assert max(once.select(*[F.abs(F.col("s")[c]) for c in X.LIMB_NAMES[:-1]]).first()) < 1 << 50
    total = X.with_sums(once, {"s": "total"}).first()["total"]
    assert total == float(Fraction(2.0 ** 29 + 0.75 + 2.0 ** -20) * 2000 * (1 << 21))
