"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are what its writing looks like rather than what it says:
the shapes of its words (runs of capitals, letters, digits and each mark, as in
`Ul.` or `l$`, longer ones in pieces of `PIECE`), how often a word repeats the one before, how many words are
distinct, and its length. Term counts are dampened and weighed by rarity, then
projected on the leading singular directions of a labelled sample. Each document
takes exact cosines with all labelled vectors, in blocks, and its `NEIGHBOURS`
nearest vote with their labels, weighted by similarity.

Fit: a bounded sample of the labelled rows (`FIT_DOCS` documents of at most
`FIT_CHARS` characters, parameters) gives the weights, the directions (an
eigenproblem of `TERMS` terms on the driver) and the labelled vectors, which are
broadcast: at most FIT_DOCS x DIMENSIONS floats, about 0.5 MB.

Scale: one narrow pass over the whole texts, no shuffle; blocks of 256 documents
against the fixed number of labelled vectors, so cost grows with the documents.

Cases: NULL and empty texts have only the terms of an empty text and vote like
any other; a document without any similar neighbour scores the labels' mean;
without usable labels every score is 0.5; several labels of one id count as the
highest; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, prepare, remainder
from tidemark.llm.toxicity import labelled_sample

SHAPES = 1024
TERMS = SHAPES + 64
DIMENSIONS = 40
NEIGHBOURS = 25
FIT_DOCS = 4000
FIT_CHARS = 20_000
THRESHOLD = 0.3
REMEMBERED = 400_000
PIECE, SHORT = 12, 64

_runs = [(re.compile(r"[0-9]+"), "0"), (re.compile(r"[^\W\d_]+"), None), (re.compile(r"(\W|_)\1+"), r"\1")]


def shape(word: str) -> str:
    """Runs of letters as U (capitals), l (small) or Ul (capitalised), digits as 0, marks as they are."""
    kind = lambda m: "U" if (s := m[0]).isupper() and len(s) > 1 else "l" if s.islower() else "Ul" if s[:1].isupper() and s[1:].islower() or len(s) == 1 else "lU"
    return _runs[2][0].sub(r"\1", _runs[0][0].sub("0", _runs[1][0].sub(kind, word)))


class Shapes(dict):
    """Word -> terms of its shape's pieces; short words are remembered, up to a bound."""

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        s = shape(word)
        t = [zlib.crc32(s[k:k + PIECE].encode("utf-8", "surrogatepass")) % SHAPES for k in range(0, len(s), PIECE)]
        if len(word) <= SHORT:
            self[word] = t
        return t


_split = re.compile(r"[^\x20\x09-\x0D]+").findall


def term_counts(text: str | None, shapes: Shapes) -> np.ndarray:
    """Dampened counts of all terms; each group of terms is a share of the document."""
    v = np.zeros(TERMS, np.float32)
    words = _split(text or "")
    n = len(words)
    if n:
        pieces = np.fromiter(chain.from_iterable(map(shapes.__getitem__, words)), np.int64)
        v[:SHAPES] = np.sqrt(np.bincount(pieces, minlength=SHAPES) / len(pieces))
        again = sum(map(operator.eq, words, words[1:])) / n
        v[SHAPES] = 2 * np.sqrt(again)
        v[SHAPES + 1 + min(9, int(10 * len(set(words)) / n))] = 0.3
    v[SHAPES + 16 + min(31, n.bit_length())] = 0.1
    return v


@dataclass
class Model:
    rarity: np.ndarray      # (TERMS,)
    axes: np.ndarray        # (TERMS, dimensions)
    vectors: np.ndarray     # (labelled, dimensions), of length 1
    labels: np.ndarray      # (labelled,)
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = (counts * self.rarity) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def vote(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = self.project(counts) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, top, 1).astype(np.float64), 0.0) ** 8
        whole = weight.sum(axis=1)
        return np.where(whole > 1e-9, (weight * self.labels[top]).sum(axis=1) / np.maximum(whole, 1e-9), self.prior)


def fit_vectors(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    rarity = np.log1p(len(labels) / (1.0 + (counts > 0).sum(axis=0))).astype(np.float32)
    x = counts * rarity
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = axes[:, ::-1][:, :dimensions].astype(np.float32)
    model = Model(rarity, axes, np.zeros((0, axes.shape[1]), np.float32), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.project(counts)
    return model


def fit(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> Model:
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array([term_counts(t, shapes).tobytes() for t in b.column("text").to_pylist()], pa.binary())], names=["id", "y", "v"])

    sample = labelled_sample(docs, labels, label_col, train, fit_docs, fit_chars, id_col, text_col).select(F.col("id").cast("string").alias("id"), F.col("y").cast("int").alias("y"), "text")
    rows = sample.mapInArrow(count, "id string, y int, v binary").toArrow().sort_by("id")
    counts = np.frombuffer(b"".join(rows.column("v").to_pylist()), np.float32).reshape(-1, TERMS)
    return fit_vectors(counts, rows.column("y").to_numpy().astype(int) if len(rows) else np.zeros(0, int))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    from pyspark.sql.types import DoubleType, StructField, StructType

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, shapes = shared.value, Shapes()
        for b in chunks(batches):
            counts = np.stack([term_counts(t, shapes) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(m.vote(counts), pa.float64())], names=["id", "score"])

    schema = StructType([StructField("id", source.schema["id"].dataType), StructField("score", DoubleType())])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score, predicted for every document, learnt from the rows that are not held out."""
    model = fit(docs, labels, remainder(id_col, modulus) != held, id_col, text_col, label_col)
    return score(docs, model, id_col, text_col).select(
        id_col, (remainder(id_col, modulus) == held).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
