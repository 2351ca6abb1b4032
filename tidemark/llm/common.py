"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path, ship_package

#: A word, in the regular expressions of both Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
CHUNK = 256
PORTION = 2 << 20
_COLLECTED: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back.

    Cuts the lineage at a place every executor can reach, so that losing an
    executor later repeats only what comes after.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    if (paths := _COLLECTED.get()) is not None:
        paths.append(path)
    return out


@contextmanager
def collected() -> Iterator[list[str]]:
    """The folders that `staged` writes inside, as they come."""
    paths: list[str] = []
    token = _COLLECTED.set(paths)
    try:
        yield paths
    finally:
        _COLLECTED.reset(token)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*done: DataFrame) -> None:
    """Removes what `staged` wrote for these DataFrames.

    For tables whose every reader has itself been written by now: neither a result nor
    a lost executor needs them again.
    """
    for df in done:
        path = getattr(df, "scratch_path", None)
        if path:
            remove(df.sparkSession, path)


ROW = "row__"


def numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows with a number of their own (`ROW`), fixed by writing them: ids may be missing or repeat."""
    return staged(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def positioned(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows sorted by `order`, written, with `position`: their place from 0, without gaps.

    Sorted in ranges, each numbered by itself; only the sizes of the ranges (one
    number each) are added up in one place.
    """
    return placed(df.repartitionByRange(*order).sortWithinPartitions(*order), label)


def placed(df: DataFrame, label: str) -> DataFrame:
    """The rows as they come, written, with `position`: their place from 0, without gaps."""
    rows = numbered(df, label)
    part = F.shiftright(F.col(ROW), 33)
    sizes = rows.groupBy(part.alias("p__")).agg(F.count("*").alias("n__"))
    before = F.sum("n__").over(Window.orderBy("p__").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("p__", F.coalesce(before, F.lit(0)).alias("start__"))
    out = rows.withColumn("p__", part).join(F.broadcast(starts), "p__")
    return out.withColumn("position", F.col("start__") + F.col(ROW).bitwiseAND((1 << 33) - 1)).drop("p__", "start__", ROW)


def commonest_length(df: DataFrame, vector: str) -> int:
    """The length most vectors have (of equally common ones the largest), 0 without rows."""
    sizes = df.groupBy(F.size(vector).alias("d")).count()
    return sizes.agg(F.max(F.struct("count", "d"))["d"]).first()[0] or 0


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a NULL id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words: bytes.lower and bytes.split know ASCII only."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a column as their bytes, which need not be decoded to be split."""
    return column.cast(pa.binary()).to_pylist()


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Small slices, so that Python objects exist for a few texts at a time."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def portions(batches: Iterator[pa.RecordBatch], column: str, size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """Slices of at most `size` bytes of a column of texts, or of one row."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            after = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield b.slice(at, after - at)
            at = after


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


#: Bits of the fixed-size filter below: 512 pieces of 4 KB.
_PIECES, _PIECE_BITS = 512, 32768


def possibly_in(df: DataFrame, column: str, keys: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows of `df` whose `column` may be among `keys`: all that are, and few others; without `keep`, the other rows.

    The keys are folded into a bitmap of 2 MB at most, whatever their number,
    so that it can be broadcast and spares shuffling the other rows. When the
    keys are too many for it the filter lets more rows through; it never drops
    a key, so an exact join must follow.
    """
    place = F.pmod(F.xxhash64(F.col(column).cast("string"), F.lit(5)), F.lit(_PIECES * _PIECE_BITS))
    bits = (
        keys.select(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(5)), F.lit(_PIECES * _PIECE_BITS)).alias("k"))
        .groupBy(F.expr(f"k div {_PIECE_BITS}").alias("piece")).agg(F.expr(f"bitmap_construct_agg(k % {_PIECE_BITS})").alias("bits"))
    )
    marked = df.withColumn("k__", place).join(F.broadcast(bits), F.expr(f"k__ div {_PIECE_BITS}") == F.col("piece"), "left")
    byte = F.expr(f"CAST(conv(hex(substring(bits, CAST((k__ % {_PIECE_BITS}) div 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    among = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, CAST(k__ % 8 AS INT))")) != 0, F.lit(False))
    return marked.where(among if keep else ~among).drop("k__", "piece", "bits")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(v, c): every vertex of the edges (a, b) with the smallest vertex of its component.

    Each round hooks every vertex to its smallest neighbour, follows the hooks
    to their roots, and contracts the edges; what is left shrinks at least by
    half a round. All state is in tables of the shared folder.
    """
    spark = edges.sparkSession
    edges = staged(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = last = staged(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n")).select("v", F.least("v", "n").alias("c")), label)
        while True:
            up = hooks.select(F.col("v").alias("x"), F.col("c").alias("y"))
            nxt = staged(hooks.join(up, hooks["c"] == up["x"]).select("v", F.col("c").alias("old"), F.col("y").alias("c")), label)
            done = nxt.where("old != c").isEmpty()
            discard(last)
            last, hooks = nxt, nxt.select("v", "c")
            if done:
                break
        step = hooks.select(F.col("v").alias("x"), F.col("c").alias("y"))
        if found is None:
            found = hooks
        else:
            found = staged(found.join(step, found["c"] == step["x"], "left").select("v", F.coalesce("y", "c").alias("c")), label)
        left = edges.join(step.withColumnsRenamed({"x": "xa", "y": "ya"}), F.col("a") == F.col("xa")).join(step.withColumnsRenamed({"x": "xb", "y": "yb"}), F.col("b") == F.col("xb"))
        edges = staged(left.where("ya != yb").select(F.least("ya", "yb").alias("a"), F.greatest("ya", "yb").alias("b")).distinct(), label)
    return found if found is not None else spark.createDataFrame([], "v long, c long")
