"""Packing: an exact round trip, and the schedule against one that goes token by token."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm import queries as Q
from tidemark.llm.common import portions

PATH = Q.vocabulary("word_bpe_49k.json")


def round_trip(got, docs, window=packing.WINDOW):
    """Every id of every document once, sequences gapless and full."""
    tok = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == {d["doc_id"] for d in docs}
    for d in docs:
        ids = np.array([*tok.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces[d["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:at].tobytes())
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for k, s in sequences.items():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or k == len(sequences) - 1 and at < window


def test_query_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    round_trip(Q.op7_packing(spark, sf).collect(), docs)


def test_odd_rows(spark):
    texts = [None, "", "  ", "Hello, world's <|endoftext|> x", "ÀÉ ß ﬁ ① é don't", "a" * 3000, "1234 x!!y @foo ŁÓDŹ İstanbul ΑΣ"]
    docs = spark.createDataFrame([(k, t, [None, "a", "b"][k % 3], "z") for k, t in enumerate(texts)], "doc_id long, text string, source string, n string")
    round_trip(packing.pack(docs, PATH, window=64).collect(), docs.collect(), 64)
    again = packing.pack(docs.unionByName(docs), PATH).collect()
    assert sum(r["length"] for r in again) == 2 * sum(r["length"] for r in packing.pack(docs, PATH).collect())
    assert packing.pack(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("max_queues", [1, 2, 3])
def test_shared_queue(spark, max_queues):
    docs = spark.createDataFrame([(k, "one two three " * k, f"s{k % 5}") for k in range(40)], "doc_id long, text string, source string")
    round_trip(packing.pack(docs, PATH, window=32, max_queues=max_queues).collect(), docs.collect(), 32)


def test_schedule_against_token_by_token():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 300, rng.integers(1, 7))
        shares = rng.integers(1, packing.SHARES, len(sizes)) if rng.random() < 0.5 else np.maximum(1, np.round(sizes / sizes.sum() * packing.SHARES)).astype(int)
        order = sorted(((2 * i + 1) * packing.TICKS // int(p), s, i) for s, (n, p) in enumerate(zip(sizes, shares, strict=True)) for i in range(n))
        plan = packing.Schedule(sizes, shares, 16)
        window = {(s, i): k // 16 for k, (_, s, i) in enumerate(order)}
        for s, n in enumerate(sizes):
            assert plan.window_of(np.full(n, s), np.arange(n)).tolist() == [window[s, i] for i in range(n)]
            doc, lo, hi, at, _ = plan.pieces(np.array([s]), np.array([0]), np.array([n]))
            for x, y, k in zip(lo, hi, at, strict=True):
                assert {window[s, i] for i in range(x, y)} == {k}


def test_every_window_holds_the_mix(spark):
    docs = spark.createDataFrame([(k, "one two three four " * 40, "ab"[k % 4 == 0]) for k in range(400)], "doc_id long, text string, source string")
    share = defaultdict(lambda: defaultdict(int))
    rows = packing.pack(docs, PATH).collect()
    for r in rows:
        share[r["sequence_id"]][r["source"]] += r["length"]
    whole = [s for k, s in share.items() if k < max(share)]
    assert whole and all(abs(s["b"] - 1024) <= 1 for s in whole)
    skewed = defaultdict(lambda: defaultdict(int))
    for r in packing.pack(docs, PATH, targets={"a": 1.0, "b": 1.0}).collect():
        skewed[r["sequence_id"]][r["source"]] += r["length"]
    assert abs(skewed[0]["a"] - 2048) <= 1 and sum(s["a"] for s in skewed.values()) == sum(s["a"] for s in share.values())


def test_columns_match_whole_texts():
    tok, t = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    rng = np.random.default_rng(8)
    bits = ["Hello", "don't", "'s", "x!!y", "ÀÉß", "ŁÓ", "İ", "1234", "<|", "endoftext", "|>", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "é", "①", "@foo", "a" * 70, "''", ",,"]
    texts = [None, "", " ", *("".join(rng.choice(bits, rng.integers(1, 12))) for _ in range(400))]
    texts = [x for x in texts if not x or not {"\x1c", "\x85", "\xa0"} & set(x)] + ["a\x1cb", "a\xa0b"]
    column = pa.array(["not looked at", *texts]).slice(1)
    for _ in range(2):
        got = [np.frombuffer(x, "<u2").tolist() for x in t.encode(column).to_pylist()]
        assert got[:-2] == [tok.encode(x or "", add_special_tokens=False).ids for x in texts[:-2]]
    assert t.encode(pa.array([], pa.string())).to_pylist() == []


def test_words_of_a_column_are_encoded_once(monkeypatch):
    t, calls = packing.WordTokenizer(PATH), []
    whole = t.encode(pa.array(["one two three four five"])).to_pylist() * 50
    t.runs = packing.Remembered(lambda r: calls.append(r) or packing.WordTokenizer._run(t, r), 2)
    assert t.encode(pa.array(["one two three four five"] * 50)).to_pylist() == whole
    assert sorted(filter(None, calls)) == ["five", "four", "one", "three", "two"]
    assert len(t.runs) <= 2 and len(t.runs.before) <= 2


def test_portions_are_bounded():
    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "", "c" * 50, "d", "e" * 9, "fg"]})
    parts = [p.column("text").to_pylist() for p in portions([batch, batch.slice(0, 0)], "text", 10)]
    assert [x for p in parts for x in p] == batch.column("text").to_pylist()
    assert all(len(p) == 1 or sum(len(x or "") for x in p) <= 10 for p in parts) and len(parts) == 4


def test_remembered_runs_take_little_memory():
    """A worker keeps what it remembers to its end, beside the JVM: far less than Python's strings would take."""
    import tracemalloc

    t = packing.WordTokenizer(PATH)
    letters = [chr(97 + k) for k in range(26)]
    column = pa.array([" ".join(a + b + c + d for c in letters for d in letters) for a in "bcdf" for b in letters[:12]])
    tracemalloc.start()
    try:
        ids = t.encode(column)
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(t.runs) > 30_000 and kept / len(t.runs) < 40
    assert t.encode(column).equals(ids)


def test_remembered_against_a_dict():
    rng, calls = np.random.default_rng(4), []
    held = packing.Remembered(lambda k: calls.append(k) or k.encode() * 2, 8)
    for _ in range(60):
        keys = [*{"x" * int(n) + str(n % 3) for n in rng.integers(0, 70, rng.integers(0, 12))}]
        assert held.of(pa.array(keys, pa.string())).to_pylist() == [k.encode() * 2 for k in keys]
        assert len(held) <= 8 and len(held.before) <= 8
    before = len(calls)
    for _ in range(2):
        held.of(pa.array(["x0", "y", "z" * 65]))
    assert calls[before:].count("y") == 1 and calls[before:].count("z" * 65) == 2
