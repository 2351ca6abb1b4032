"""Toxicity and quality: accuracy on rows held out, located sentences, odd rows."""

import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm import quality_knn as K
from tidemark.llm import toxicity as X

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, score string, label int"


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()


# Some labels of this table are wrong: toxic documents without any toxic word, and the reverse.
@pytest.mark.parametrize("query, label, modulus, held, least", [(Q.op6_toxicity, "toxic", 4, 2, 0.9), (Q.op10_quality_knn, "quality", 5, 0, 0.98)])
def test_held_out(spark, query, label, modulus, held, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = query(spark, SF).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % modulus == held for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    out = both[both.held_out]
    assert auc(out.score.to_numpy(), out[label].to_numpy()) > least
    assert (out.predicted == out[label]).mean() > 0.96


def test_located_sentences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = X.fit(docs, labels, F.lit(True))
    found = {r["doc_id"] for r in X.locate(docs, model).collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len(found & toxic) > 0.8 * len(toxic) and len(found & clean) < 0.02 * len(clean)
    kept = X.reject(docs, model)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(left & clean) > 0.98 * len(clean) and len(left & toxic) < 0.1 * len(toxic)


ODD = [(0, None, "a", 1), (1, "", "a", 1), (2, " . ! ", "a", 1), (3, "x" * 20000, "a", 1), (4, "bad word. " * 3000, "a", 1), (5, "A b\x00c é日", "a", 1), (5, "A b\x00c é日", "a", 1), (None, "no id", "a", 1)]


@pytest.mark.parametrize("module, label", [(X, "toxic"), (K, "quality")])
def test_odd_rows(spark, module, label):
    df = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 1), (4, 0), (99, 1), (None, 1), (3, None)], f"doc_id long, {label} int")
    got = module.classify(df, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert module.classify(df.limit(0), labels).count() == 0
    assert module.classify(df, labels.limit(0)).count() == len(ODD)


def test_noisy_or():
    model = X.Model(-2.0, {b: 3.0 for b in X.buckets("scum")})
    p = lambda t: 1 / (1 + np.exp(-X.Scorer(model).logits(t)))
    text = "all fine here. you scum! bye"
    assert X.Scorer(model).score(text) == pytest.approx(1 - np.prod(1 - p(text)))
    assert np.argmax(p(text)) == 1


def test_length_alone_is_not_toxic(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    s = X.fit(docs, labels, F.lit(True)).scorer()
    plain = "all fine here.\n"
    assert s.score(plain * 70_000) == s.score(plain) == s.score("") == 0
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "toxic").orderBy("doc_id").collect()
    scored = [(r["text"], r["toxic"], s.score(r["text"])) for r in rows if r["text"]]
    clean = [t for t, toxic, p in scored if not toxic and p < 0.3]
    whole = "\n".join(clean)
    million = whole[: whole.rindex("\n", 0, 1_100_000)]
    assert len(million) > 1_000_000 and s.score(million) < 0.1
    toxic = [t for t, toxic, p in scored if toxic and p >= 0.3 and len(t) < 2000][:40]
    found = [s.score(f"{million}\n{t}") >= 0.3 for t in toxic]
    assert len(found) == 40 and sum(found) >= 38


def test_whole_of_long_words_counts():
    start, shapes = "日本語、" * 20, K.Shapes()
    one, other = K.term_counts(start + "日本語。" * 500, shapes), K.term_counts(start + "A1$b;" * 500, shapes)
    assert not np.array_equal(one, other)
    assert (one[:K.SHAPES] ** 2).sum() == pytest.approx(1) and not any(len(w) > K.SHORT for w in shapes)
    late = K.term_counts(start + "日本語、" * 500 + "x9?" * 40, shapes)
    assert not np.array_equal(late, K.term_counts(start + "日本語、" * 530, shapes))
    assert K.shape("Hello,") == "Ul," and shapes["Hello,"] == shapes["World,"] and len(shapes["Hello,"]) == 1


def test_vote_is_exact():
    rng = np.random.default_rng(0)
    counts, y = rng.random((300, K.TERMS)).astype(np.float32), (rng.random(300) < 0.5).astype(int)
    m = K.fit_vectors(counts, y)
    got = m.vote(counts[:20])
    near = m.project(counts[:20]) @ m.vectors.T
    for k in range(20):
        top = np.argsort(-near[k])[:K.NEIGHBOURS]
        w = np.maximum(near[k][top].astype(float), 0) ** 8
        assert got[k] == pytest.approx((w * y[top]).sum() / w.sum(), rel=1e-6)
