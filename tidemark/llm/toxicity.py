"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores sigmoid(bias + weights of
its distinct words), where a word weighs the sum of its hashed features: the
word, its first four and five letters and its last four. A sentence whose words
do not add up to more than nothing scores 0, however many there are: length
alone makes no text toxic. A document is toxic if any sentence is, which
noisy-or expresses: 1 - prod(1 - p). Labels exist for documents only; the
gradient of the noisy-or gives each sentence its part of the blame, so the
trained sentence scores also locate the offending sentences (`locate`).

Fit: on a bounded sample of the labelled rows (`FIT_DOCS` documents of at most
`FIT_CHARS` characters, both parameters), chosen by a hash of the id. Executors
turn the sample into word ids; the gradient descent on them is one small numpy
problem. Only the weights that are not zero are sent back, at most `BUCKETS`.

Scale: scoring is one narrow pass over the whole texts, no shuffle. The labels'
sample is broadcast (at most `FIT_DOCS` ids), so no text moves for the fit.

Cases: NULL and empty texts are one empty sentence and score 0, as any text does
that has no telling word; documents without label are scored like any other; several labels of one id
count as the highest; without usable labels every score is 0; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, prepare, remainder

BUCKETS = 1 << 18
FIT_DOCS = 4000
FIT_CHARS = 20_000
THRESHOLD = 0.3
PLAIN = 0.02
REMEMBERED = 150_000

_sentences = re.compile(r"[.!?\n]+").split
_words = re.compile(r"[^\W_]+").findall


def buckets(word: str) -> set[int]:
    """Hashed features of a word; the marks keep heads and tails apart from words."""
    return {zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in (word, f"{word[:4]}>", f"{word[:5]}>", f"<{word[-4:]}")}


def sentences(text: str | None) -> list[str]:
    return [s for s in _sentences((text or "").lower()) if s.strip()] or [""]


@dataclass
class Model:
    bias: float
    weights: dict[int, float]
    longest: float = np.inf  # sentences of the longest text of the fit

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer(dict):
    """Word -> weight, remembered up to a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        w = self[word] = sum(self.model.weights.get(b, 0.0) for b in buckets(word))
        return w

    def logits(self, text: str | None) -> np.ndarray:
        """By sentence; minus infinity where the words weigh nothing or less."""
        get = self.__getitem__
        w = np.array([sum(map(get, set(_words(s)))) for s in sentences(text)], float)
        return np.where(w > 0, self.model.bias + w, -np.inf)

    def score(self, text: str | None) -> float:
        """Noisy-or over the sentences: 1 - exp(-sum of softplus).

        Words that tell little turn up by chance, the more the longer a text is.
        In texts longer than those of the fit a sentence therefore adds to others
        by its share of the text; by itself it counts in full at any length.
        """
        z = self.logits(text)
        over = np.log(max(1.0, len(z) / self.model.longest))
        return float(-np.expm1(-max(np.logaddexp(0.0, z - over).sum(), np.logaddexp(0.0, z.max()))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train, fit_docs: int, fit_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, y) of at most `fit_docs` labelled rows, by a hash of the id."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(F.col(id_col).alias("chosen")).agg(F.max(label_col).alias("y"))
        .orderBy(F.xxhash64("chosen", F.lit(17)), "chosen").limit(fit_docs)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.coalesce(F.length("text"), F.lit(0)) <= fit_chars)
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("chosen")).select("id", "text", "y")


def sentence_features(sentence: str) -> list[int]:
    return sorted(b for w in set(_words(sentence)) for b in buckets(w))


def telling(ids: np.ndarray, ends: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features that occur in toxic documents too often for chance. `ends` says where each document's ids end.

    The bar is a likelihood ratio above what one in as many features as there are
    would reach by chance; features whose documents are mostly clean never do.
    A small sample may have none, and then nothing is called toxic.
    """
    bad, all_ = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for start, end, toxic in zip(np.append(0, ends[:-1]), ends, y, strict=True):
        once = np.unique(ids[start:end])
        all_[once] += 1
        bad[once] += toxic
    rate = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        part = bad / all_
        ratio = 2 * (bad * np.log(part / rate) + np.where(bad < all_, (all_ - bad) * np.log((1 - part) / (1 - rate)), 0.0))
        return np.flatnonzero((all_ > 0) & (part > max(rate, 0.5)) & (ratio > 2 * np.log((all_ > 0).sum()) + 4))


def train_noisy_or(ids: np.ndarray, sizes: np.ndarray, n_sentences: np.ndarray, y: np.ndarray, rounds: int = 600) -> Model:
    """Gradient descent (Adam) on the documents' log loss, over the telling features.

    `ids` has the features of all sentences one after the other, `sizes` their
    number by sentence, `n_sentences` the sentences by document. The number of
    rounds bounds the weights of separable data. The bias is where telling
    sentences start from: as many as the longest text of the sample has, with
    next to no weight, would score `PLAIN`. Sentences without telling features
    count neither here nor in `Scorer`.
    """
    if not len(y) or not y.any():
        return Model(-30.0, {})
    # Most features tell nothing; only places of those that do become arrays.
    ends = np.cumsum(sizes, dtype=np.int64)
    used = telling(ids, np.append(0, ends)[np.cumsum(n_sentences)], y) if not y.all() else np.unique(ids)
    if not len(used):
        return Model(-30.0, {})
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    where = np.flatnonzero(place[ids] >= 0)
    at, sentence = place[ids[where]], np.searchsorted(ends, where, side="right")
    doc = np.repeat(np.arange(len(y)), n_sentences)
    some, sentence = np.unique(sentence, return_inverse=True)
    doc = doc[some]
    bias = float(np.log(PLAIN / n_sentences.max()))
    w, mean, square = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence, w[at], len(some))
        total = np.bincount(doc, np.logaddexp(0.0, z), len(y))
        blame = np.where(y == 1, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) / len(y)
        g = blame[doc] / (1.0 + np.exp(-z))
        gw = np.bincount(at, g[sentence], len(used))
        mean, square = 0.9 * mean + 0.1 * gw, 0.999 * square + 0.001 * gw * gw
        w -= 0.05 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return Model(bias, dict(zip(used.tolist(), w.tolist(), strict=True)), float(n_sentences.max()))


def fit(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> Model:
    prepare(docs.sparkSession)

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            bags = [[sentence_features(s) for s in sentences(t)] for t in b.column("text").to_pylist()]
            ids = [np.array([i for s in bag for i in s], "<i4").tobytes() for bag in bags]
            sizes = [np.array([len(s) for s in bag], "<i4").tobytes() for bag in bags]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(ids, pa.binary()), pa.array(sizes, pa.binary())], names=["id", "y", "ids", "sizes"])

    sample = labelled_sample(docs, labels, label_col, train, fit_docs, fit_chars, id_col, text_col).select(F.col("id").cast("string").alias("id"), F.col("y").cast("int").alias("y"), "text")
    rows = sample.mapInArrow(to_ids, "id string, y int, ids binary, sizes binary").toArrow().sort_by("id")
    if not len(rows):
        return train_noisy_or(*[np.zeros(0, np.int64)] * 4)
    sizes, y = rows.column("sizes").to_pylist(), rows.column("y").to_numpy().astype(int)
    ids = np.frombuffer(b"".join(x.as_py() for x in rows.column("ids")), "<i4")
    del rows
    return train_noisy_or(ids, np.frombuffer(b"".join(sizes), "<i4"), np.array([len(x) // 4 for x in sizes]), y)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document."""
    prepare(docs.sparkSession)
    from pyspark.sql.types import DoubleType, StructField, StructType

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = model.scorer()
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([s.score(t) for t in b.column("text").to_pylist()], pa.float64())], names=["id", "score"])

    schema = StructType([StructField("id", source.schema["id"].dataType), StructField("score", DoubleType())])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def reject(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, that score under `threshold`."""
    whole = docs.select(F.struct("*").alias("k"), F.col(text_col).alias("t"))
    return score(whole, model, "k", "t").where(F.col("score") < threshold).select("k.*")


def locate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The offending sentences: id, sentence_no (from 0, of sentences with text), score, sentence (lower case)."""
    prepare(docs.sparkSession)
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = model.scorer()
        for b in chunks(batches):
            at, number, p, text = [], [], [], []
            for k, t in enumerate(b.column("text").to_pylist()):
                split = sentences(t)
                for j, x in enumerate(1.0 / (1.0 + np.exp(-s.logits(t)))):
                    if x >= threshold:
                        at.append(k), number.append(j), p.append(float(x)), text.append(split[j])
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int64())), pa.array(number, pa.int64()), pa.array(p, pa.float64()), pa.array(text, pa.string())], names=["id", "sentence_no", "score", "sentence"])

    schema = StructType([StructField("id", source.schema["id"].dataType), StructField("sentence_no", LongType()), StructField("score", DoubleType()), StructField("sentence", StringType())])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id, held_out, score, predicted for every document, learnt from the rows that are not held out."""
    model = fit(docs, labels, remainder(id_col, modulus) != held, id_col, text_col, label_col)
    return score(docs, model, id_col, text_col).select(
        id_col, (remainder(id_col, modulus) == held).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
