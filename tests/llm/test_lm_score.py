"""Base scores against plain Python; the model as a distribution, and on texts it has not seen."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm import lm_score as L
from tidemark.llm import queries as Q


def base(rows, training):
    counts = Counter()
    for r in rows:
        if training(r):
            counts.update(L.tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda t: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    counts, n, score = base(docs, lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2)
    got = {r["doc_id"]: r for r in Q.op1_lm_score(spark, sf).collect()}
    assert len(got) == len(docs)
    ahead = tokens = 0
    for d in docs:
        r, t = got[d["doc_id"]], L.tokens(d["text"])
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(score(t), rel=1e-12)
        if r["held_out"]:
            ahead, tokens = ahead + r["score"] - r["base_score"], tokens + len(t)
    assert ahead / tokens > 0.3  # log10 a token, on texts it has not seen


def test_probabilities_sum_to_one(spark):
    rows = [(k, " ".join(f"w{(k * j) % 37}" for j in range(1, 30)) + f" only{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = L.word_counts(docs, "text").cache()
    table = L.frequent(counts, 20)
    model = L.train(docs, table, "text", "doc_id")
    arrays, codes = table.arrays(), L.Codes(table.words)
    count = {bytes(r["word"]): r["c"] for r in counts.collect()}
    whole, freed = table.rare_total, table.discount * table.rare_distinct / table.rare_total
    for history in ([], [b"w1"], [b"w3", b"only5"], [b"nowhere", b""]):
        total, rare_class = 0.0, None
        for w in [*count, b"unknown"]:
            flat = np.array([codes[x] for x in [*history, w]])
            first = np.array([0])
            p = math.exp(L.token_logs(model, flat, first, arrays)[-1])
            if flat[-1] >= len(table.words):
                assert rare_class is None or rare_class == pytest.approx(p)
                rare_class, p = p, p * ((count[w] - table.discount) / whole if w in count else freed)
            total += p
        assert total == pytest.approx(1.0, abs=1e-4)


def test_odd_rows(spark):
    rows = [(k, t, 1.0) for k, t in enumerate([None, "", "  \n", "A a a", "x" * 9000, "b " * 3000, "a\x00b é"])]
    df = spark.createDataFrame([*rows, rows[3], (None, "a", 0.0)], "doc_id long, text string, score double")
    got = L.split_scores(df).collect()
    assert len(got) == 9 and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (0, 1, 2)} == {1}
    assert L.split_scores(df.limit(0)).count() == 0
    none = L.score(df, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in none)


def test_hash_of_words_is_the_same_on_both_sides(spark):
    import xxhash

    ws = [b"a", "ü日".encode(), b"x" * 100, b""]
    got = [r[0] for r in spark.createDataFrame([(bytearray(w),) for w in ws], "w binary").select(F.xxhash64("w")).collect()]
    assert got == [int(np.uint64(xxhash.xxh64_intdigest(w, 42)).astype(np.int64)) for w in ws]


def test_columns_give_the_tokens_of_each_text():
    import pyarrow as pa

    texts = ["not looked at", None, "", " ", "  \n", " A\tb B ", "x" * 100, "É Ⅷ A\x0b\x0cb\x1cc\r", "a\xa0b", "z Z z", " "]
    codes = L.Codes([b"a", b"z", b"", b"no"])
    for column in (pa.array(texts).slice(1), pa.array(texts).slice(4, 3), pa.array(["a"]).slice(0, 0)):
        want = [L.tokens(None if t is None else t.encode()) for t in column.to_pylist()]
        found, each, sizes = L.token_columns(column)
        assert found.take(pa.array(each)).to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
        assert codes.of(found).tolist() == [codes[w] for w in found.to_pylist()]


def test_each_distinct_word_of_a_column_is_looked_up_once(monkeypatch):
    import pyarrow as pa

    asked = []
    monkeypatch.setattr(L.zlib, "crc32", lambda w: asked.append(w) or 7)
    column = pa.array(["one two three two"] * 500)
    codes = L.Codes([b"one", b""])
    flat = L._coded(column, codes)[2]
    assert len(flat) == 2500 and sorted(asked) == [b"ree", b"two"] and not set(flat.tolist()) - {0, 1, 2 + 7}


def test_sums_by_row_are_those_of_reduceat_to_the_bit():
    rng = np.random.default_rng(6)
    for n in (1, 7, 300, L.BATCH):
        rows = np.minimum(rng.zipf(1.3, n), L.ROWS - 1).astype(np.int64)
        gradient = rng.standard_normal((n, L.CLASSES)).astype(np.float32)
        order = np.argsort(rows, kind="stable")
        unique, starts, counts = np.unique(rows[order], return_index=True, return_counts=True)
        got = L.row_sums(rows, gradient)
        assert np.array_equal(got[0], unique) and np.array_equal(got[1], counts)
        assert np.array_equal(got[2], np.add.reduceat(gradient[order], starts, axis=0))
