"""Token counts against the library itself."""

import random

import pytest
import sentencepiece

from tidemark.llm import queries as Q
from tidemark.llm.token_counts import PairMerger, token_counts

PATH = Q.vocabulary("piece_bpe_32k.model")
HARD = [None, "", " ", "   ", "a  b", "\n\n x\n", "\ta", "a▁b ▁", "<s>x</s> <unk>", "①ﬁé　​", "a\x00b", "…" * 5, " " * 700 + "x" + " " * 33, "é" * 3000, "x" * 5000, "😀👩‍👩‍👧 ok"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_hard_texts(library):
    m = PairMerger(PATH)
    for t in HARD:
        assert m.text(t) == len(library.encode(t or "")), t


def test_random_texts(library):
    rng, m = random.Random(5), PairMerger(PATH)
    for _ in range(400):
        t = "".join(rng.choice("ab e the th\n .,|é ß①▁") for _ in range(rng.randrange(1, 120)))
        assert m.text(t) == len(library.encode(t)), t


def test_operator_on_odd_rows(spark, library):
    rows = [(k, t, "x", 1) for k, t in enumerate(HARD)] + [(1, "a a", "x", 1), (None, "b", None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int")
    got = token_counts(df, PATH, limit=10).collect()
    assert len(got) == len(rows)
    texts = sorted((len((t or "").encode()), len(library.encode(t or ""))) for _, t, *_ in rows)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == texts
    assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in got)
    assert token_counts(df.limit(0), PATH).count() == 0


def test_query_equals_library(spark, sf, library):
    got = {r["doc_id"]: r for r in Q.op9_token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d["doc_id"]]["n_tokens"] == len(library.encode(d["text"] or ""))
        assert got[d["doc_id"]]["n_bytes"] == len((d["text"] or "").encode())
