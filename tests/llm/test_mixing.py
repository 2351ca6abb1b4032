"""Water-filling against the iterative definition, and what the sample takes."""

import random
from collections import defaultdict

import pytest

from tidemark.llm.mixing import mix, mixture

SCHEMA = "doc_id long, text string, source string, size int"


def filled(sizes, weights=(5, 2, 1), top=3):
    """Share by weight, clamp, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / whole > top * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / whole for s in open_}
            break
        for s in over:
            target[s] = float(top * sizes[s])
            open_.remove(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def corpus(seed, sources=6, docs=300):
    rng = random.Random(seed)
    names = [None, *[f"s{k}" for k in range(sources)]]
    return [(k, " ".join(["w"] * rng.choice([0, 1, 5, 30, 200])), rng.choices(names, [2 ** k for k in range(len(names))])[0], 7) for k in range(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_takings(spark, seed):
    rows = corpus(seed)
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["size"] * r["copies"]
    target = filled(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-9, abs=1e-9)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 100.5  # half the largest document
    again = mix(spark.createDataFrame(rows[::-1], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in got)


def test_odd_rows(spark):
    rows = [(None, None, None, 1), (1, "a b", "x", 1), (1, "a b", "x", 1), (2, "", "y", 2), (3, "w " * 5000, "z", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix(df).collect()
    assert len(got) == 5 and sum(r["size"] for r in got) == 5004
    assert mix(df.limit(0)).count() == 0
    assert mix(spark.createDataFrame([(1, " ", "x", 1)], SCHEMA)).first()["taken"] == 0


def test_mixture_repeats_rows(spark):
    df = spark.createDataFrame(corpus(4), SCHEMA)
    copies = {r["doc_id"]: r["copies"] for r in mix(df).collect()}
    out = mixture(df)
    assert out.columns == df.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r["doc_id"]] += 1
    assert seen == {k: c for k, c in copies.items() if c}
