"""Embedding whitening with MLlib's BlockMatrix.

Vectors become whole numbers (`SCALE` steps a unit, shifted by `SHIFT`). The fit
list, every distinct vector once, gives exact sums per dimension; its centred
rows are indexed into a BlockMatrix whose transpose times itself is the scatter
matrix. That is as small as the dimension squared and is decomposed on the
driver; multiplying the BlockMatrix of all rows by the whitening matrix (unit
eigenvectors over the roots of their eigenvalues) projects them. The whitened
fit list goes through the same product once more, as a check.

Scale: rows are indexed without gaps by their place in the staged table; a block
holds `BLOCK_BYTES`, and the product over the row blocks is split, so that no task
adds up more than `SPLIT` of them. The driver gets one row of sums per dimension and
matrices of dimension times dimension. Copies of one vector, however many, are one group that
is combined map-side; nothing is joined by vector, only by row number.

Cases: rows whose vector is NULL, empty, holds NULL or non-finite entries, or
entries beyond `LIMIT` (their squares have no exact place in a long), take no part,
nor do vectors of another length than the commonest (of equally common ones
the longest). NULL and repeated ids are rows like others. A direction without variance (eigenvalue under
`RANK` of the largest) has no component, so a table of one distinct vector, or an empty
one, gives no rows. A deviation beyond 38 digits is NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import commonest_length, placed, prepare, staged

SCALE, SHIFT = 64, 1_000_000
LIMIT = 1 << 46
COMPONENTS = 16
BLOCK_BYTES = 1 << 21
COLUMNS = 1024
SPLIT = 32
RANK = 1e-10
_LOW = 26  # bits of the lower half of a number, summed by itself


def whole(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the rows that take part, as whole numbers."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < float(LIMIT // SCALE), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(fine & (F.size(v) > 0), v).alias("v")).where("v IS NOT NULL")
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def blocks_of(rows: DataFrame, columns: int, n_rows: int) -> BlockMatrix:
    """Rows (position, v: array<double>) as blocks; places without a row are zero."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select(F.col("position").alias("index"), array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(indexed, n_rows, columns).toBlockMatrix(max(1, BLOCK_BYTES // 8 // columns), min(columns, COLUMNS))


def gram(m: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix; the row blocks are dealt out in groups and their products added pairwise."""
    splits = -(-m.numRowBlocks // SPLIT)
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def times(spark: SparkSession, m: BlockMatrix, right: np.ndarray) -> DataFrame:
    """(position, w): the rows of the matrix times a small local one."""
    step, k = m.colsPerBlock, right.shape[1]
    pieces = [((j, 0), Matrices.dense(min(step, len(right) - at), k, right[at:at + step].ravel(order="F"))) for j, at in enumerate(range(0, len(right), step))]
    other = BlockMatrix(spark.sparkContext.parallelize(pieces, 1), step, k, len(right), k)
    product = callMLlibFunc("getMatrixBlocks", m.multiply(other)._java_matrix_wrapper._java_model)
    prepare(spark)
    rows_per_block = m.rowsPerBlock

    def unblock(batches):
        for b in batches:
            for at, matrix in zip(b.column(0).to_pylist(), b.column(1)):
                values = matrix["values"].values.to_numpy(zero_copy_only=False)
                n, columns, turned = matrix["numRows"].as_py(), matrix["numCols"].as_py(), matrix["isTransposed"].as_py()
                dense = values.reshape((n, columns) if turned else (columns, n))
                flat = np.ascontiguousarray(dense if turned else dense.T).ravel()
                w = pa.ListArray.from_arrays(pa.array(np.arange(0, n * columns + 1, columns), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(at["_1"] * rows_per_block + np.arange(n), pa.int64()), w], names=["position", "w"])

    return product.mapInArrow(unblock, "position long, w array<double>")


def sums(fit: DataFrame) -> list[tuple[int, int, int, int]]:
    """(rows, sum, least, largest) of every dimension, exact: lower and upper halves are added by themselves."""
    each = fit.select(F.posexplode("x").alias("at", "c"))
    low = F.col("c").bitwiseAND((1 << _LOW) - 1)
    got = each.groupBy("at").agg(F.count("*"), F.sum(F.shiftright("c", _LOW)), F.sum(low), F.min("c"), F.max("c")).orderBy("at").collect()
    return [(r[1], (r[2] << _LOW) + r[3], r[4], r[5]) for r in got]


def _scaled(n: int, totals: list[tuple[int, int, int, int]]) -> tuple[Column, bool]:
    """n * x - S of column x, as longs, or as decimals where their squares would pass a long."""
    bound = sum(max(abs(n * lo - s), abs(n * hi - s)) ** 2 for _, s, lo, hi in totals)
    fits = bound < 1 << 63 and n * max(abs(x) for t in totals for x in t[2:]) < 1 << 63
    kind = "long" if fits else "decimal(38,0)"
    s = F.array(*[F.lit(str(t[1])).cast(kind) for t in totals])
    return F.zip_with(F.col("x"), s, lambda c, t: (c.cast(kind) * F.lit(n) if fits else F.try_multiply(c.cast("decimal(19,0)"), F.lit(n).cast("decimal(19,0)"))) - t), fits


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per participating row: id, position, n, deviation decimal(38,0), w array<double> (whitened), explained array<double>, identity_error."""
    spark = vectors.sparkSession
    rows = whole(vectors, id_col, vector_col)
    length = commonest_length(rows, "x")
    schema = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, position long, n long, deviation decimal(38,0), w array<double>, explained array<double>, identity_error double"
    if not length:
        return spark.createDataFrame([], schema)
    rows = placed(rows.where(F.size("x") == length), "whiten-rows")
    n_rows = int(rows.agg(F.max("position")).first()[0]) + 1
    fit = staged(rows.groupBy("x").agg(F.min("position").alias("position")), "whiten-fit")
    totals = sums(fit)
    n, d = totals[0][0], len(totals)
    scaled, fits = _scaled(n, totals)
    centred = F.transform(scaled, lambda c: c.cast("double") / F.lit(float(n)))

    scatter = gram(blocks_of(fit.select("position", centred.alias("v")), d, n_rows))
    values, unit = np.linalg.eigh((scatter + scatter.T) / 2 / n)
    order = np.argsort(values)[::-1][:components]
    order = [k for k in order if values[k] > max(values[-1], 0) * RANK]
    if not order:
        return spark.createDataFrame([], schema)
    white = times(spark, blocks_of(rows.select("position", centred.alias("v")), d, n_rows), unit[:, order] / np.sqrt(values[order]))

    square = F.aggregate(scaled, F.lit(0).cast("long" if fits else "decimal(38,0)"), lambda a, c: a + c * c if fits else F.try_add(a, F.try_multiply(c, c)).cast("decimal(38,0)"))
    facts = rows.select("position", "id", square.cast("decimal(38,0)").alias("deviation"))
    out = staged(facts.join(white, "position"), "whiten-rows-out")
    check = gram(blocks_of(out.join(fit.select("position"), "position", "left_semi").select("position", F.col("w").alias("v")), len(order), n_rows)) / n
    error = float(np.abs(check - np.eye(len(order))).max())
    share = [float(values[k] / values.sum()) for k in order]
    return out.select(F.col("id").alias(id_col), "position", F.lit(n).cast("long").alias("n"), "deviation", "w", F.array(*[F.lit(s) for s in share]).alias("explained"), F.lit(error).alias("identity_error"))


def components_long(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per row and component, numbered from 1 by falling eigenvalue."""
    each = whitened.select(id_col, "n", F.col("deviation").cast("long").alias("deviation"), F.posexplode(F.arrays_zip("w", "explained")).alias("at", "c"), "identity_error")
    return each.select(id_col, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.w").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
