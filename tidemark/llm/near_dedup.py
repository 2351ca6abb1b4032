"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its distinct `size`-word shingles. Equal sets form
one class, named by a 64-bit hash, before anything is compared. A class enters
some sorted orders, each by `DEPTH` MinHash values of its own. Candidates are
neighbours by longest common prefix: a region is a run of rows that share the
first `FIRST` values. In a small region (up to `REGION` rows) all are neighbours;
in a larger one the depth grows: a row's neighbours are the nearest before it in
the order, which share the longest prefixes. Estimates from the signature drop
hopeless candidates (4 standard deviations below the threshold), and every
other one is confirmed on the full sets.

Dense regions have an exact second step, so that no link is lost to the limited
neighbourhood: after the components of the first step, the members of regions
that were too large, or that a partition boundary cut, are compared in blocks of
`BLOCK` on their full sets, across components only, and each block gives just
the links that join components. Dense regions therefore cost blocks, spread over
tasks, and give at most as many rows as they have members.

There are as many orders as leave a link just at the threshold unfound with
probability `MISSED` (10 at 0.85, 13 at 0.8); closer links are missed less.

Scale: exact copies collapse map-side; orders are range-partitioned, which is
even whatever the groups; only small rows are shuffled until the confirmation,
for which only classes that have candidates fetch their texts. Components are
found by contraction over tables in the shared folder.

Cases: NULL or wordless texts are empty, linked with nothing; fewer words than a
shingle make one shingle; repeated ids are told apart by their sets; a row
without id takes part, and its component is named by the ids there are; an empty
table gives an empty result; other columns are carried only where asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, WORD, chunks, components, discard, numbered, possibly_in, prepare, staged, words

SHINGLE = 3
PERCENT = 85
DEPTH, FIRST, MOST_ORDERS = 8, 3, 40
REGION, NEIGHBOURS, BLOCK = 48, 4, 256
REMEMBERED = 150_000
MISSED = 1e-4

_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(0, 1 << 31, MOST_ORDERS * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, MOST_ORDERS * DEPTH, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def orders(percent: int) -> int:
    """How many orders leave a link just at the threshold unfound with probability `MISSED` at most."""
    together = (percent / 100) ** FIRST
    return min(MOST_ORDERS, max(4, math.ceil(math.log(MISSED) / math.log(1 - together)))) if together < 1 else 1


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    width = min(size, len(h))
    many = len(h) - width + 1
    x = np.full(many, width, np.uint64)
    for k in range(width):
        x = (x ^ h[k:k + many]) * _ODD[k % 16]
        x ^= x >> np.uint64(29)
    return np.unique(x)


def signature(s: np.ndarray, hashes: int) -> np.ndarray:
    x = ((s ^ (s >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    low = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 4096):
        low = np.minimum(low, ((x[None, k:k + 4096] * _MULTIPLY[:hashes, None]) ^ _FLIP[:hashes, None]).min(axis=1))
    return low


def signed(docs: DataFrame, size: int, trees: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, h, keys): per document its set's size and class, and 16 bits of each MinHash value."""
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in chunks(batches):
            sets = [shingles(t, hashes, size) for t in b.column("text").to_pylist()]
            names = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            keys = [(signature(s, trees * DEPTH) >> np.uint32(16)).astype(">u2").tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(keys, pa.binary())], names=["id", "text_hash", "n", "h", "keys"])

    schema = StructType([StructField("id", source.schema["id"].dataType), StructField("text_hash", LongType()), StructField("n", LongType()), StructField("h", LongType()), StructField("keys", BinaryType())])
    return source.mapInArrow(run, schema)


def forest(classes: DataFrame, trees: int) -> DataFrame:
    """One row per class and order: (tree, key, h, keys)."""
    each = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    return classes.select("h", "keys", each.alias("tree")).withColumn("key", F.expr(f"substring(keys, tree * {2 * DEPTH} + 1, {2 * DEPTH})"))


def _neighbours(least: float, hashes: int):
    """Scan of one partition of sorted orders -> candidate pairs (a, b) and members (a, NULL, region) of regions to do in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                if b.num_rows:
                    tree = b.column("tree").to_numpy().astype(np.uint64)
                    key = np.frombuffer(b"".join(b.column("key").to_pylist()), ">u2").reshape(-1, DEPTH).astype(np.uint64)
                    region = tree
                    for k in range(FIRST):
                        region = (region << np.uint64(16)) | key[:, k]
                    yield region, b.column("h").to_numpy(), np.frombuffer(b"".join(b.column("keys").to_pylist()), np.uint8).reshape(-1, 2 * hashes)[:, 1::2]

        def pairs(h, sketch, window):
            """Rows against up to `window` rows before them."""
            a, b = [], []
            for back in range(1, min(window, len(h) - 1) + 1):
                near = np.flatnonzero((sketch[back:] == sketch[:-back]).mean(axis=1) >= least)
                a.append(h[near]), b.append(h[near + back])
            return (np.concatenate(a), np.concatenate(b)) if a else (h[:0], h[:0])

        def out(a, b, region=None):
            none = region is None
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()) if none else pa.array(region.astype(np.int64), pa.int64())], names=["a", "b", "region"])

        first_region, held, dense = None, None, False  # held: rows of the run not yet ended; dense: it outgrew REGION and its rows are members already
        for region, h, sketch in rows():
            if first_region is None:
                first_region = region[0]
            if held is not None:
                region, h, sketch = (np.concatenate(x) for x in zip(held[:3], (region, h, sketch), strict=True))
                known = len(held[1]) if dense else 0
            else:
                known = 0
            starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
            ends = np.append(starts[1:], len(region))
            got = []
            for k in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == len(starts) - 1) | (region[starts] == first_region)):
                s, e = starts[k], ends[k]
                last, grown = k == len(starts) - 1, dense and k == 0
                if e - s > REGION or grown:
                    new = s + (known if grown else 0)
                    got.append(out(h[new:e], None, region[new:e]))
                    got.append(out(*pairs(h[s:e], sketch[s:e], NEIGHBOURS)))
                elif not last:
                    got.append(out(*pairs(h[s:e], sketch[s:e], REGION)))
                    if region[s] == first_region:
                        got.append(out(h[s:e], None, region[s:e]))
            s, e = starts[-1], ends[-1]
            dense = e - s > REGION or (dense and len(starts) == 1)
            s = max(s, e - NEIGHBOURS) if dense else s
            held = (region[s:e], h[s:e], sketch[s:e])
            yield from (g for g in got if g.num_rows)
        if held is not None and not dense:  # the last run may go on in the next partition
            yield out(*pairs(held[1], held[2], REGION))
            yield out(held[1], None, held[0])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            both = np.array([len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)], np.int64)
            ok = pa.array(100 * both >= percent * (na + nb - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], names=["a", "b"])

    return run


def block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join components, among the rows (h, c, n, s) of two blocks of a region."""
    rows = rows.drop_duplicates("h")
    sets = [np.frombuffer(s, "<u8") for s in rows["s"]]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[place] > 1  # a shingle of one row only adds nothing
    column = (np.cumsum(times > 1) - 1)[place[shared]]
    owner, width = owner[shared], int((times > 1).sum())
    both = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(0, width, 8192):
        here = (column >= k) & (column < k + 8192)
        m = np.zeros((len(sets), min(8192, width - k)), np.float32)
        m[owner[here], column[here] - k] = 1.0
        both += m @ m.T
    n, c, h = rows["n"].to_numpy(), rows["c"].to_numpy(), rows["h"].to_numpy()
    linked = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (c[:, None] != c[None, :])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    a, b = [], []
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        x, y = find(c[i]), find(c[j])
        if x != y:
            root[y] = x
            a.append(h[i]), b.append(h[j])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept, text_hash and set_hash (the class)."""
    spark = docs.sparkSession
    prepare(spark)
    trees = orders(percent)
    sig = staged(signed(docs, shingle, trees, id_col, text_col), "near-signatures")
    classes = staged(sig.where("n > 0").groupBy("h").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-classes")

    least = percent / 100 - 4 * (percent / 100 * (1 - percent / 100) / (trees * DEPTH)) ** 0.5
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = forest(classes, trees).repartitionByRange(parts, "tree", "key").sortWithinPartitions("tree", "key")
    found = staged(ordered.mapInArrow(_neighbours(least, trees * DEPTH), "a long, b long, region long"), "near-candidates")
    pairs = found.where("b IS NOT NULL AND a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    members = found.where("region IS NOT NULL").select("region", F.col("a").alias("h"))
    # A region of one row has nothing to compare.
    crowded = members.groupBy("region").agg(F.count("*").alias("rows")).where("rows > 1")
    members = staged(members.join(crowded, "region"), "near-members")
    pairs = staged(pairs, "near-pairs")

    involved = pairs.select(F.explode(F.array("a", "b")).alias("x")).unionByName(members.select(F.col("h").alias("x"))).distinct()
    sets = staged(full_sets(docs, classes, involved, shingle, id_col, text_col), "near-sets")
    a, b = sets.toDF("a", "na", "sa"), sets.toDF("b", "nb", "sb")
    links = staged(pairs.join(a, "a").join(b, "b").mapInArrow(_confirm(percent), "a long, b long"), "near-links")
    discard(found, pairs)
    names = components(links, "near-components")

    placed = members.join(names, members["h"] == names["v"], "left").select("region", "h", F.coalesce("c", "h").alias("c"), "rows")
    open_regions = placed.groupBy("region").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 != c2").select("region")
    placed = staged(placed.join(open_regions, "region"), "near-regions")
    if not placed.isEmpty():
        blocks = F.expr(f"CAST(ceil(rows / {BLOCK}) AS INT)")
        own = F.pmod(F.xxhash64("h"), blocks)
        spread = (
            placed.withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .join(sets, "h").select("region", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "h", "c", "n", "s")
        )
        more = spread.groupBy("region", "p", "q").applyInPandas(lambda rows: block_links(rows, percent), "a long, b long")
        more = staged(more, "near-links")
        discard(sets, placed)
        if not more.isEmpty():
            names = components(links.unionByName(more), "near-components")
    else:
        discard(sets, placed)
    discard(members)

    smallest = classes.select("h", "id").join(names, classes["h"] == names["v"], "left").select("h", "id", F.coalesce("c", "h").alias("c"))
    by_component = smallest.groupBy("c").agg(F.min("id").alias("component"))
    lookup = smallest.join(by_component, "c").select(F.col("h").alias("class"), "component")
    out = sig.join(lookup, (sig["h"] == lookup["class"]) & (sig["n"] > 0), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), "text_hash", F.col("h").alias("set_hash"))


def keep_one(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, without those that are a near duplicate of one that stays.

    Of each group the row with the smallest id stays, and one only: rows are told
    apart by a number of their own, which breaks ties. A row without id stays only
    in a group that has no id at all.
    """
    rows = numbered(docs, "near-rows")
    found = near_duplicates(rows, percent, shingle, ROW, text_col).select(F.col(ROW).alias("r"), F.col("component_id").alias("c"))
    places = staged(rows.select(ROW, F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.col(ROW).alias("r")).alias("place")).join(found, F.col(ROW) == F.col("r")).select("c", "place"), "near-places")
    stays = places.groupBy("c").agg(F.min("place").alias("place"), F.count("*").alias("n")).where("n > 1").select(F.col("c").alias("group"), F.col("place.r").alias("stays"))
    gone = staged(places.join(stays, F.col("c") == F.col("group")).where("place.r != stays").select(F.col("place.r").alias("r")), "near-gone")
    maybe = possibly_in(rows, ROW, gone, "r").join(gone, F.col(ROW) == F.col("r"), "left_anti")
    return possibly_in(rows, ROW, gone, "r", keep=False).unionByName(maybe).select(docs.columns)


def full_sets(docs: DataFrame, classes: DataFrame, involved: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(h, n, s): the whole shingle set of every class of `involved` (x), as sorted 64-bit hashes."""
    wanted = staged(classes.join(involved, classes["h"] == involved["x"]).select("h", F.col("id").alias("wanted")), "near-wanted")
    texts = possibly_in(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "id", wanted.where("wanted IS NOT NULL"), "wanted")
    texts = texts.join(wanted.where("wanted IS NOT NULL").select("wanted").distinct(), F.col("id") == F.col("wanted")).select("text")
    if not wanted.where("wanted IS NULL").isEmpty():  # classes of which no row has an id
        texts = texts.unionByName(docs.where(F.col(id_col).isNull()).select(F.col(text_col).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in chunks(batches):
            sets = [shingles(t, hashes, size) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["h", "n", "s"])

    return texts.mapInArrow(run, "h long, n long, s binary").dropDuplicates(["h"])


SQL = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= {PERCENT} * (p.n + q.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM texts UNION SELECT w.b, r.c FROM reach r JOIN ways w ON w.a = r.doc_id WHERE r.c < w.b)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.c AS component_id, t.doc_id = m.c AS kept
FROM texts t LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) m USING (doc_id)
"""
