"""Hard-negative mining: bounds along a spanning tree of anchors, exact scores where they matter.

A score is the inner product of whole-number vectors. Anchors are taken in
blocks, each with a minimum spanning tree. The root of a tree is scored exactly against
every candidate; for a child whose parent's score lies in [lo, hi] it lies in
[lo - e |v|, hi + e |v|], e the length of the edge and |v| the candidate's norm. Only
candidates whose range meets what the anchor still looks for are scored
exactly (which narrows the ranges below them again): for the positives, what may enter its
best `POSITIVES` of the same label; for the negatives, what may enter the best
`NEGATIVES` of one of its windows, of another label. The windows are
`LOWER` to `UPPER` percent of the positive's score.

Scale: a chunk of `CHUNK` anchors, their trees and windows is broadcast (its size does not grow
with the table), the candidates stream past it in as many tasks as there are
cores, twice (positives, then negatives), and only each task's best rows of every
anchor are shuffled. The table is read twice for each chunk, which is what a stated
query set against all rows costs; no candidate is dropped without a bound that rules it out.

Cases: rows with a NULL label, a NULL or empty vector, or NULL or non-finite
entries take no part, nor do vectors of another length than the commonest, or of
`LIMIT` or more (their products have no place in a long). Rows with a NULL id are
candidates, last among ties, but no anchors. Rows are told apart by their
place, so rows of one id are other rows to each other. An anchor without
positives, or without rows in a window, gives no rows there; so does an empty
table. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, chunks, commonest_length, numbered, placed, prepare
from tidemark.session import scratch_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOWER, UPPER = 30, 90
LIMIT = 2.0**31
BLOCK, CHUNK = 1024, 16_384
#: Candidates scored at a time.
BATCH = 1024
_NO_ID = np.iinfo(np.int64).max
_FOUND = "anchor int, win int, id long, row long, score long"


class Tree(NamedTuple):
    """A block of anchors, as places in the chunk, level by level from the root: (anchors, their parents' places in the block, edges)."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    size: int


def spanning_tree(a: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels (nodes, parents, edge lengths) of a minimum spanning tree of the rows; the first level is the root."""
    norms = (a * a).sum(1)
    d2 = np.maximum(norms[:, None] + norms[None, :] - 2 * a @ a.T, 0)
    root = int(np.sqrt(d2).sum(1).argmin())
    near, parent = d2[root].copy(), np.full(len(a), root)
    inside, depth = np.zeros(len(a), bool), np.zeros(len(a), int)
    inside[root] = True
    for _ in range(len(a) - 1):
        k = int(np.where(inside, np.inf, near).argmin())
        inside[k], depth[k] = True, depth[parent[k]] + 1
        closer = d2[k] < near
        near[closer & ~inside], parent[closer & ~inside] = d2[k][closer & ~inside], k
    # Straight from the difference, so that rounding shows in the last bits only.
    edges = np.sqrt(((a - a[parent]) ** 2).sum(1))
    return [(at, parent[at], edges[at]) for d in range(int(depth.max()) + 1) for at in [np.flatnonzero(depth == d)]]


class Best:
    """The best k (score falling, id rising) of every key, of rows given in any order; only the keys a call names are sorted again."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.score, self.ids, self.row = (np.zeros((keys, k), np.int64) for _ in range(3))
        self.count = np.zeros(keys, np.int64)
        self.least = np.full(keys, np.iinfo(np.int64).min)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(key):
            return
        named, key = np.unique(key, return_inverse=True)
        old, at = np.nonzero(np.arange(self.k) < self.count[named][:, None])
        key = np.concatenate([old, key])
        score, ids, row = (np.concatenate([held[named[old], at], x]) for held, x in ((self.score, score), (self.ids, ids), (self.row, row)))
        order = np.lexsort((row, ids, -score, key))
        key, score, ids, row = key[order], score[order], ids[order], row[order]
        many = np.bincount(key, minlength=len(named))
        place = np.arange(len(key)) - (np.cumsum(many) - many)[key]
        keep = place < self.k
        into = named[key[keep]], place[keep]
        self.score[into], self.ids[into], self.row[into] = score[keep], ids[keep], row[keep]
        self.count[named] = np.minimum(many, self.k)
        full = named[many >= self.k]
        self.least[full] = self.score[full, self.k - 1]

    @property
    def held(self) -> tuple[np.ndarray, ...]:
        """(key, score, id, row) of all, by key, the best first."""
        key, at = np.nonzero(np.arange(self.k) < self.count[:, None])
        return key, self.score[key, at], self.ids[key, at], self.row[key, at]


class Chunk(NamedTuple):
    """Anchors with what each looks for: rows of the same label or of another, in windows from `lo` to `hi`."""

    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    trees: list[Tree]
    starts: list[int]
    lo: np.ndarray  # anchors x windows
    hi: np.ndarray
    same: bool
    k: int


def search(chunk: Chunk, best: Best, v: np.ndarray, norms: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> int:
    """Folds a batch of candidates into `best`; returns how many scores were worked out."""
    windows, scored = chunk.lo.shape[1], 0
    for tree, start in zip(chunk.trees, chunk.starts):
        low, high = np.empty((tree.size, len(v))), np.empty((tree.size, len(v)))
        found = []  # an anchor is met once, so what its tree finds can wait to be sorted in at once
        for level, (at, parent, edge) in enumerate(tree.levels):
            who = start + at
            wanted = (chunk.labels[who][:, None] == labels) == chunk.same
            wanted &= chunk.rows[who][:, None] != rows
            if level:
                width = edge[:, None] * norms * (1 + 1e-9) + 1e-15 * np.maximum(np.abs(low[parent]), np.abs(high[parent]))
                low[at], high[at] = low[parent] - width, high[parent] + width
                meets = np.zeros(wanted.shape, bool)
                for w in range(windows):
                    floor = np.maximum(chunk.lo[who, w], best.least[who * windows + w])
                    meets |= (high[at] * (1 + 1e-15) + 1 > floor[:, None]) & (low[at] - 1 < chunk.hi[who, w][:, None] * (1 + 1e-15)) & (floor <= chunk.hi[who, w])[:, None]
                wanted &= meets
                across, down = np.flatnonzero(wanted.any(0)), np.flatnonzero(wanted.any(1))
            else:
                across, down = np.arange(len(v)), np.arange(len(at))
            if not len(across):
                continue
            exact = np.rint(chunk.vectors[who[down]] @ v[across].T).astype(np.int64) if v.dtype == np.float64 else chunk.vectors[who[down]] @ v[across].T
            scored += exact.size
            inside = np.ix_(at[down], across)
            low[inside] = high[inside] = exact
            for w in range(windows):
                floor, top = np.maximum(chunk.lo[who[down], w], best.least[who[down] * windows + w]), chunk.hi[who[down], w]
                fits = wanted[np.ix_(down, across)] & (exact >= floor[:, None]) & (exact <= top[:, None])
                if len(across) > chunk.k and np.count_nonzero(fits) > 4 * chunk.k * len(down):  # at first nearly all fit
                    last = np.partition(np.where(fits, exact, np.iinfo(np.int64).min), -chunk.k, axis=1)[:, -chunk.k]
                    fits &= exact >= last[:, None]
                i, j = np.nonzero(fits)
                found.append((who[down[i]] * windows + w, exact[i, j], ids[across[j]], rows[across[j]]))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found)))
    return scored


def _pass(rows: DataFrame, chunk: Chunk, dimension: int, exact_in_double: bool) -> DataFrame:
    """Every key's best over all candidates: (anchor, win, id, row, score)."""
    sc = rows.sparkSession.sparkContext
    sent, windows, k = sc.broadcast(chunk), chunk.lo.shape[1], chunk.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = sent.value
        best = Best(chunk.lo.size, chunk.k)
        for b in chunks(batches, BATCH):
            q = b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            norms = np.sqrt((q.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
            ids = b.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            search(chunk, best, q.astype(np.float64) if exact_in_double else q, norms, b.column("label").to_numpy(zero_copy_only=False), ids, b.column(ROW).to_numpy(zero_copy_only=False))
        key, score, ids, row = best.held
        found = [pa.array(key // windows, pa.int32()), pa.array(key % windows, pa.int32()), pa.array(ids, mask=ids == _NO_ID), pa.array(row), pa.array(score)]
        table = pa.Table.from_arrays(found, names=["anchor", "win", "id", "row", "score"])
        yield from table.to_batches(65_536)

    # No more tasks than run at once: each hands over a list for every anchor.
    found = rows.select(ROW, "id", "label", "q").coalesce(max(1, sc.defaultParallelism)).mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def whole(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, q): the rows that take part, as whole numbers."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < LIMIT / SCALE, F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.when(fine & (F.size(v) > 0), v).alias("v"))
    rows = rows.where("v IS NOT NULL AND label IS NOT NULL").select("id", "label", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("q"))
    return rows.where(F.aggregate("q", F.lit(0.0), lambda a, c: a + c * c) < LIMIT * LIMIT)


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", chunk_size: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); `anchors`: which rows are."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = whole(vectors, id_col, label_col, vector_col)
    dimension = commonest_length(rows, "q")
    path = scratch_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not dimension:
        return spark.createDataFrame([], schema)
    rows = numbered(rows.where(F.size("q") == dimension), "negatives-rows")
    asking = rows.withColumnsRenamed({"id": id_col, "label": label_col}).where(anchors).where(F.col(id_col).isNotNull())
    # Rows of one label are likelier near each other; a block is a run in this order.
    asking = placed(asking.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), "q", F.col(ROW).alias("own")).orderBy("label", "id", "own"), "negatives-anchors")
    count, largest = asking.count(), rows.agg(F.max(F.aggregate("q", F.lit(0.0), lambda a, c: a + c * c))).first()[0]
    exact_in_double = largest < 2.0**52
    spark.createDataFrame([], schema).write.parquet(path)
    for at in range(0, count, chunk_size):
        part = asking.where(F.col("position").between(at, at + chunk_size - 1)).orderBy("position").toArrow()
        q = part["q"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
        a = q.astype(np.float64)
        starts = list(range(0, len(a), block))
        trees = [Tree(spanning_tree(a[s:s + block]), len(a[s:s + block])) for s in starts]
        ids, n = part["id"].to_numpy(), len(a)
        anything = np.iinfo(np.int64)
        first = Chunk(a if exact_in_double else q, part["label"].to_numpy(), part["own"].to_numpy(), trees, starts, np.full((n, 1), anything.min), np.full((n, 1), anything.max), True, POSITIVES)
        found = _pass(rows, first, dimension, exact_in_double).select("anchor", "place", "id", "score").toArrow()
        who, place, score = found["anchor"].to_numpy(), found["place"].to_numpy() - 1, found["score"].to_numpy()
        lo, hi = np.full((n, POSITIVES), anything.max), np.full((n, POSITIVES), anything.min)
        # Whole-number borders of LOWER p <= 100 s <= UPPER p.
        lo[who, place], hi[who, place] = -((-LOWER * score) // 100), UPPER * score // 100
        positives = spark.createDataFrame(pa.table({
            "anchor": pa.array(who, pa.int32()), "win": pa.array(place, pa.int32()), "anchor_id": pa.array(ids[who]), "positive_id": found["id"], "positive_score": pa.array(score),
        }))
        second = first._replace(lo=lo, hi=hi, same=False, k=NEGATIVES)
        negatives = _pass(rows, second, dimension, exact_in_double)
        negatives.join(positives, ["anchor", "win"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(c::DOUBLE * {SCALE}) FOR c IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same) WHERE place <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOWER} * p.score <= 100 * n.score AND 100 * n.score <= {UPPER} * p.score)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE place <= {NEGATIVES}
"""
