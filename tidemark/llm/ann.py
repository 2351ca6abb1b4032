"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors form one class first, so that copies neither crowd a graph nor
cost a search; a class is known by its vector's hash and its smallest id.
Classes are dealt to shards by that hash. One task builds the hierarchical
graph of a shard: levels fall geometrically, each new vector is linked to a
diverse choice of the nearest found, and lists that grow too long are pruned by
the same rule. A finished shard is one row of flat arrays (vectors, neighbours of
the ground level, neighbours of the upper levels with offsets), written to the
shared folder. Queries go in blocks to every shard; the shards' nearest are
merged, classes are turned into their rows, and ranked by distance, then id.

Distances that steer the search are single precision; the distances returned
are computed from the original vectors in double precision.

Scale: shards hold `SHARD` classes whatever the size of the table; a hot vector
is one class, whose members are cut to the few smallest ids in two steps (by a
salt, then by class) before any join, which loses nothing as no query can list
more. Queries of equal vectors are searched once.

Cases: vectors that are NULL, empty, all zero, or hold a NULL or non-finite
component take no part, as query or candidate; vectors of another length than
the query's are no candidates; rows without id are no queries and no candidates;
rows of one id are never candidates of each other; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, staged

SHARD = 8192
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 14, 80, 128
QUERY_BLOCK = 512
SALTS = 32


class Graph:
    """Flat arrays: x (n, dim), ground (n, 2 links), up (rows, links) with up_at[node] the row of its level 1, level by node."""

    def __init__(self, x: np.ndarray, links: int = LINKS):
        self.x64 = x
        self.x = np.ascontiguousarray(x, np.float32)
        self.square = np.einsum("ij,ij->i", self.x, self.x)
        self.links = links
        self.stamp = np.zeros(len(x), np.int32)
        self.now = 0

    @classmethod
    def build(cls, x: np.ndarray, seed: int, links: int = LINKS, width: int = BUILD_WIDTH) -> Graph:
        g = cls(x, links)
        n = len(x)
        g.level = np.minimum(-np.log(1.0 - np.random.default_rng(seed).random(n)) / math.log(links), 12).astype(np.int32)
        g.up_at = (np.cumsum(g.level) - g.level).astype(np.int32)
        g.ground = np.full((n, 2 * links), -1, np.int32)
        g.up = np.full((int(g.level.sum()), links), -1, np.int32)
        g.top = 0
        for k in range(1, n):
            g._insert(k, width)
            if g.level[k] > g.level[g.top]:
                g.top = k
        return g

    def _list(self, node: int, level: int) -> np.ndarray:
        return self.ground[node] if level == 0 else self.up[self.up_at[node] + level - 1]

    def _far(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.square[nodes] - 2.0 * (self.x[nodes] @ q)

    def _walk(self, q: np.ndarray, entry: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The `width` nearest found from `entry`, nearest first."""
        self.now += 1
        stamp, now = self.stamp, self.now
        ahead, best = list(entry), [(-d, v) for d, v in entry]
        heapq.heapify(ahead), heapq.heapify(best)
        for _, v in entry:
            stamp[v] = now
        while ahead:
            d, v = heapq.heappop(ahead)
            if d > -best[0][0] and len(best) >= width:
                break
            near = self._list(v, level)
            near = near[near >= 0]
            near = near[stamp[near] != now]
            if not len(near):
                continue
            stamp[near] = now
            far = self._far(q, near)
            if len(best) >= width:
                some = far < -best[0][0]
                near, far = near[some], far[some]
            for e, u in zip(far.tolist(), near.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (-e, u))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, u))
                else:
                    continue
                heapq.heappush(ahead, (e, u))
        return sorted((-d, v) for d, v in best)

    def _diverse(self, nodes: np.ndarray, far: np.ndarray, many: int) -> np.ndarray:
        """Nearest first, leaving out those nearer to a chosen one; then filled up with the nearest left out."""
        if len(nodes) <= many:
            return nodes
        order = np.argsort(far, kind="stable")
        nodes, far = nodes[order], far[order]
        between = self.square[nodes][:, None] + self.square[nodes][None, :] - 2.0 * (self.x[nodes] @ self.x[nodes].T)
        free, chosen = np.ones(len(nodes), bool), []
        for k in range(len(nodes)):
            if free[k]:
                chosen.append(k)
                if len(chosen) == many:
                    break
                free &= between[k] >= far
        rest = [k for k in range(len(nodes)) if k not in set(chosen)]
        return nodes[(chosen + rest)[:many]]

    def _insert(self, k: int, width: int) -> None:
        q, top = self.x[k], self.level[self.top]
        entry = [(float(self._far(q, np.array([self.top]))[0]), self.top)]
        for level in range(top, self.level[k], -1):
            entry = self._walk(q, entry, 1, level)[:1]
        for level in range(min(top, self.level[k]), -1, -1):
            entry = self._walk(q, entry, width, level)
            limit = 2 * self.links if level == 0 else self.links
            far, nodes = np.array([d for d, _ in entry], np.float32) + self.square[k], np.array([v for _, v in entry], np.int32)
            chosen = self._diverse(nodes, far, self.links)
            self._list(k, level)[:len(chosen)] = chosen
            for v in chosen.tolist():
                row = self._list(v, level)
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = k
                else:
                    both = np.append(row, np.int32(k))
                    kept = self._diverse(both, self._far(self.x[v], both) + self.square[v], limit)
                    row[:] = -1
                    row[:len(kept)] = kept

    def search(self, q: np.ndarray, many: int, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and exact distances of the `many` nearest found."""
        q32 = q.astype(np.float32)
        entry = [(float(self._far(q32, np.array([self.top]))[0]), self.top)]
        for level in range(self.level[self.top], 0, -1):
            entry = self._walk(q32, entry, 1, level)[:1]
        nodes = np.array([v for _, v in self._walk(q32, entry, max(width, many), 0)])
        gap = self.x64[nodes] - q
        exact = np.sqrt((gap * gap).sum(axis=1))
        order = np.lexsort((nodes, exact))[:many]
        return nodes[order], exact[order]


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, h) of the rows that take part; v in double precision."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = table.select(F.col(id_col).alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False))).withColumn("h", F.xxhash64("v", F.size("v")))


def graphs(classes: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per shard: dim and flat arrays. `classes` has (h, first, v)."""
    counts = {r["dim"]: r["n"] for r in classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc()).limit(1000).collect()}
    # Vectors of rare lengths beyond the first thousand lengths share one shard each.
    shards = F.coalesce(F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // shard))] or [F.lit(0), F.lit(1)])[F.size("v")], F.lit(1))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h", kind="stable")
        x = np.stack(rows["v"].to_list()).astype(np.float64)
        g = Graph.build(x, seed=len(x))
        return pd.DataFrame({
            "dim": [x.shape[1]], "shard": rows["shard"].iloc[:1].to_list(), "h": [rows["h"].to_numpy(np.int64).tobytes()], "first": [rows["first"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()],
            "level": [g.level.tobytes()], "ground": [g.ground.tobytes()], "up": [g.up.tobytes()], "top": [g.top]})

    placed = classes.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("h", F.lit(3)), shards).cast("int"))
    return placed.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, h binary, first binary, x binary, level binary, ground binary, up binary, top int")


def load(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray]:
    g = Graph(np.frombuffer(row["x"], np.float64).reshape(-1, row["dim"]))
    g.level = np.frombuffer(row["level"], np.int32)
    g.up_at = (np.cumsum(g.level) - g.level).astype(np.int32)
    g.ground = np.frombuffer(row["ground"], np.int32).reshape(len(g.level), -1)
    g.up = np.frombuffer(row["up"], np.int32).reshape(-1, g.links)
    g.top = int(row["top"])
    return g, np.frombuffer(row["h"], np.int64), np.frombuffer(row["first"], np.int64)


def nearest(table: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of each query row, its own id left out. `is_query` is a condition on the row."""
    spark = table.sparkSession
    prepare(spark)
    rows = vectors(table, id_col, vector_col)
    many = k + 1  # a query's own class may have no other row

    # The few smallest rows of every class: by salt first, so that a hot class is many small groups.
    small = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    members = rows.select("h", "id").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    members = members.withColumn("r", small("h", "salt")).where(F.col("r") <= many).withColumn("r", small("h")).where(F.col("r") <= many).select("h", "id")
    members = staged(members, "ann-members")
    classes = staged(rows.groupBy("h").agg(F.min("id").cast("long").alias("first"), F.first("v").alias("v")), "ann-classes")
    built = staged(graphs(classes, shard), "ann-graphs")

    asked = staged(table.where(is_query).select(F.col(id_col).alias("id")).distinct().join(rows, "id").select("id", "h"), "ann-queries")
    wanted = asked.select("h").distinct().join(classes, "h").withColumn("dim", F.size("v"))
    n_queries = wanted.count()
    blocks = -(-n_queries // QUERY_BLOCK) or 1
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("h", F.lit(9)), F.lit(blocks)).cast("int"))
    places = built.select(F.col("dim").alias("d"), F.col("shard").alias("s")).distinct()
    sent = wanted.join(places, F.col("dim") == F.col("d")).select(F.col("d").alias("dim"), F.col("s").alias("shard"), "block", F.col("h").alias("q"), "v").toDF("gd", "gs", "gb", "q", "v")
    spread = built.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "h": [], "first": [], "d": []}
        if len(graph) and len(queries):
            g, h, first = load(graph.iloc[0])
            for q, v in zip(queries["q"], queries["v"], strict=True):
                nodes, d = g.search(np.asarray(v, np.float64), many)
                out["q"].append(np.full(len(nodes), q)), out["h"].append(h[nodes]), out["first"].append(first[nodes]), out["d"].append(d)
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0) for c, x in out.items()}).astype({"q": "int64", "h": "int64", "first": "int64", "d": "float64"})

    found = spread.groupBy("dim", "shard", "block").cogroup(sent.groupBy("gd", "gs", "gb")).applyInPandas(search, "q long, h long, first long, d double")
    merged = staged(found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "first", "h"))).where(F.col("r") <= many).select("q", "h", "d"), "ann-found")

    listed = asked.select(F.col("id").alias("query_id"), F.col("h").alias("q")).join(merged, "q").join(members, "h").where("id != query_id")
    ranked = listed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("d", "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), F.col("d").alias("score"))


def exact_nearest(x: np.ndarray, ids: np.ndarray, query: int, k: int = 10) -> list[tuple[int, float]]:
    """Brute force for one query, to measure recall against."""
    d = np.sqrt(((x - x[query]) ** 2).sum(axis=1))
    order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[query]][:k]
    return [(int(ids[j]), float(d[j])) for j in order]
