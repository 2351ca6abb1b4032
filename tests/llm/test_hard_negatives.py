"""Hard negatives against plain loops; bounds hold; ties, copies, odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, anchor int, q string"


def plain(rows, every=100):
    """Rows (id, vector, label) as the operator takes them -> sorted result rows."""
    good = [(k, i, l, [math.floor(256 * float(np.float32(c))) for c in v]) for k, (i, v, l) in enumerate(rows) if l is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for k, i, l, q in good:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, p)), math.inf if j is None else j, j, m == l) for h, j, m, p in good if h != k)
        for s, _, j, same in [x for x in scored if x[3]][:5]:
            window = [x for x in scored if not x[3] and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(i, j, r, n, -s, -t) for r, (t, _, n, _) in enumerate(window[:10], 1)]
    return sorted(out, key=repr)


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, l, "clash", 1, "clash") for i, v, l in rows], SCHEMA).repartition(parts)


def clustered(n, d, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    return [(k, [float(c) for c in centres[k % 6] + rng.normal(size=d) * spread], int(rng.integers(4)) if k % 3 else k % 6 % 4) for k in range(n)]


def test_matches_plain_loop(spark):
    rows = clustered(600, 8, 1)
    got = H.mine(frame(spark, rows), F.col("vec_id") % 20 == 0, block=7, chunk_size=16).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 20)


def test_ties_copies_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    few = [[float(x) for x in rng.integers(-2, 3, 3) / 4] for _ in range(12)]
    rows = [(k, few[k % 12], k % 3) for k in range(240)]
    rows += [(500 + k, few[0], 1) for k in range(300)]
    rows += [(1000, None, 1), (1020, [1.0, None, 0.0], 1), (1040, [math.nan, 0.0, 0.0], 1), (1060, few[1], None), (1080, [], 2), (1100, [0.0, 0.0, 0.0], 0), (None, few[2], 1), (None, few[3], 2), (1120, [-1.0, -1.0, -1.0], 2)]
    df = frame(spark, rows).unionByName(frame(spark, [(1140, [1.0, 1.0], 1)]))
    got = H.mine(df, F.col("vec_id") % 20 == 0, block=5).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 20)


def test_no_rows_no_positives(spark):
    assert H.mine(frame(spark, [], 1), F.col("vec_id") % 20 == 0).count() == 0
    alone = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 2)]
    assert H.mine(frame(spark, alone, 1), F.col("vec_id") % 20 == 0).count() == 0
    no_anchor = [(k, [1.0, 0.0], k % 2) for k in range(1, 19)]
    assert H.mine(frame(spark, no_anchor, 1), F.col("vec_id") % 20 == 0).count() == 0


def test_long_vectors_are_scored_exactly(spark):
    rows = [(i, [c * 60_000 for c in v], l) for i, v, l in clustered(200, 6, 5)]
    got = H.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 20)


def test_tree_spans_and_bounds_spare_scores():
    a = np.rint(np.array([v for _, v, _ in clustered(200, 8, 3, 0.02)]) * 256)
    levels = H.spanning_tree(a)
    assert sorted(np.concatenate([x[0] for x in levels])) == list(range(200))
    for (at, parent, edge), above in zip(levels[1:], levels):
        assert set(parent) <= set(above[0])
        assert np.allclose(edge, np.sqrt(((a[at] - a[parent]) ** 2).sum(1)))
    tree = H.Tree(levels, 200)
    v = np.rint(np.array([v for _, v, _ in clustered(1000, 8, 4, 0.02)]) * 256)
    high = np.full((200, 1), int((a @ v.T).max()))
    chunk = H.Chunk(a, np.zeros(200, np.int64), np.arange(-200, 0), [tree], [0], (high * 0.99).astype(np.int64), high, False, 10)
    best = H.Best(200, 10)
    scored = H.search(chunk, best, v, np.sqrt((v * v).sum(1)), np.ones(1000, np.int64), np.arange(1000), np.arange(1000))
    assert scored < 200 * 1000 * 0.5
    exact = (a @ v.T).astype(np.int64)
    for k in range(200):
        fit = sorted((-exact[k, j], j) for j in range(1000) if chunk.lo[k, 0] <= exact[k, j] <= chunk.hi[k, 0])[:10]
        mine = [(-s, i) for key, s, i in zip(*best.held[:3]) if key == k]
        assert mine == fit


def test_a_few_new_rows_do_not_sort_all_that_is_held(monkeypatch):
    rng = np.random.default_rng(5)
    key, score, ids = np.repeat(np.arange(300), 40), rng.integers(0, 30, 12_000), rng.permutation(12_000)
    best, sizes, sort = H.Best(300, 10), [], np.lexsort
    monkeypatch.setattr(H.np, "lexsort", lambda by: sizes.append(len(by[0])) or sort(by))
    for part in np.array_split(rng.permutation(12_000), 7):
        best.add(key[part], score[part], ids[part], ids[part])
    best.add(np.array([7]), np.array([99]), np.array([0]), np.array([-1]))
    assert sizes[-1] <= 11
    held = list(zip(*(x.tolist() for x in best.held)))
    want = [(k, *x) for k in range(300) for x in sorted([(s, i, i) for c, s, i in zip(key.tolist(), score.tolist(), ids.tolist()) if c == k] + [(99, 0, -1)] * (k == 7), key=lambda x: (-x[0], x[1], x[2]))[:10]]
    assert held == want
    assert all(best.least[k] == [x for x in want if x[0] == k][-1][1] for k in range(300))


def test_a_tree_hands_over_once_a_batch(monkeypatch):
    a = np.rint(np.random.default_rng(6).normal(size=(60, 8)) * 256)
    v = np.rint(np.random.default_rng(7).normal(size=(500, 8)) * 256)
    chunk = H.Chunk(a, np.zeros(60, np.int64), np.arange(-60, 0), [H.Tree(H.spanning_tree(a), 60)], [0], np.full((60, 2), 0), np.full((60, 2), 10**9), False, 10)
    best, calls, add = H.Best(120, 10), [], H.Best.add
    monkeypatch.setattr(H.Best, "add", lambda self, key, *x: calls.append(len(key)) or add(self, key, *x))
    H.search(chunk, best, v, np.sqrt((v * v).sum(1)), np.ones(500, np.int64), np.arange(500), np.arange(500))
    assert len(calls) == 1 and calls[0] < 60 * 2 * 40
    exact = (a @ v.T).astype(np.int64)
    want = [(k * 2 + w, *x) for k in range(60) for w in range(2) for x in sorted(((s, j, j) for j, s in enumerate(exact[k].tolist()) if s >= 0), key=lambda x: (-x[0], x[1]))[:10]]
    assert list(zip(*(x.tolist() for x in best.held))) == want
