"""Components against all pairs, in small and in dense groups."""

import random

import pytest

from tidemark.llm import near_dedup as N
from tidemark.llm.common import components, words

SCHEMA = "doc_id long, text string, h string, n int"


def brute(rows, percent=85, size=3):
    sets = []
    for i, text, *_ in rows:
        w = words(text)
        sets.append((i, {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and find(a) != find(b):
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    return sorted((i, len(s), min(groups[find(k)]), i == min(groups[find(k)])) for k, (i, s) in enumerate(sets))


def result(df, **how):
    return sorted(tuple(r) for r in N.near_duplicates(df, **how).select("doc_id", "n_shingles", "component_id", "kept").collect())


def family(rng, size, copies, most):
    seed = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
    for _ in range(copies):
        w = list(seed)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
        yield " ".join(w)


@pytest.mark.parametrize("how", [{}, {"percent": 80, "shingle": 5}])
def test_small_groups(spark, how):
    rng = random.Random(11)
    texts = [t for _ in range(25) for t in family(rng, rng.randrange(1, 120), rng.randrange(1, 6), 3)]
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts + [t.upper() for t in texts[::9]] + [None, "", " ", "a", "a b", "A  B"])]
    rng.shuffle(rows)
    assert result(spark.createDataFrame(rows, SCHEMA), **how) == brute(rows, **{"percent": how.get("percent", 85), "size": how.get("shingle", 3)})


def test_dense_group_is_exact(spark):
    """One family far larger than a region, with links just at the threshold."""
    rng = random.Random(4)
    rows = [(k, t, "x", 1) for k, t in enumerate([*family(rng, 100, 400, 9), *family(rng, 60, 30, 2)])]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, "one two three four", "x", 1), (5, "one two three four", "x", 1), (5, "other words are here", "x", 1), (2, "ONE two\tthree\nfour", "x", 1), (9, "v " * 20000 + "end", "x", 1)]
    df = spark.createDataFrame([*rows, (None, "one two three four", "x", 1), (None, "all alone out here", "x", 1)], SCHEMA)
    got = N.near_duplicates(df).collect()
    assert len(got) == 7
    assert sorted(r["component_id"] for r in got if r["doc_id"] == 5) == [2, 2, 5]
    alone = [r for r in got if r["doc_id"] is None]
    assert sorted((r["component_id"], r["kept"]) for r in alone if r["component_id"]) == [(2, False)]
    assert [r["kept"] for r in alone if r["component_id"] is None] == [True]
    assert N.near_duplicates(df.limit(0)).count() == 0
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["text"][:5] for r in kept.collect()) == ["ONE t", "all a", "other", "v v v"]


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 70), (70, 90), (5, 5)]
    got = {r["v"]: r["c"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 70: 70, 90: 70, 100: 70}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
