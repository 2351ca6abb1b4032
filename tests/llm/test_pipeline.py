"""Every stage of the pipeline on its own input, against brute force."""

from collections import Counter

import pytest

import corpus_pipeline as P
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import filled
from tests.llm.test_near_dedup import brute as brute_groups
from tests.llm.test_packing import round_trip
from tidemark.llm.common import staged


@pytest.fixture(scope="module")
def inputs(spark, sf):
    """What each stage read, and at last what came out."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = staged(stage(spark, docs, sf), f"test-{name}")
        out.append(docs)
    return out


def test_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_all_but_the_last_return_documents(inputs):
    assert all(x.schema == inputs[0].schema for x in inputs[1:-1])


def test_toxic_documents_go(spark, sf, inputs):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r["doc_id"] for r in inputs[1].select("doc_id").collect()}
    clean = [i for i, y in labels.items() if not y]
    toxic = [i for i, y in labels.items() if y]
    assert sum(i in left for i in clean) >= 0.97 * len(clean)
    assert len(toxic) and len(left) <= inputs[0].count()  # a hundred rows teach next to nothing; test_classifiers has a larger table


def test_repeated_lines_go(inputs):
    rows = [(r["doc_id"], r["text"]) for r in inputs[1].collect()]
    dropped = {(i, k) for i, k, *_, kept in brute_lines(rows, 2, 30) if not kept}
    want = {}
    for i, text in rows:
        lines = [x for k, x in enumerate((text or "").split("\n")) if (i, k) not in dropped]
        if any(j == i for j, _ in dropped):
            if "".join(lines).strip(" \t\n\x0b\x0c\r"):
                want[i] = "\n".join(lines)
        else:
            want[i] = text
    assert {r["doc_id"]: r["text"] for r in inputs[2].collect()} == want


def test_one_of_each_group_stays(inputs):
    rows = [(r["doc_id"], r["text"]) for r in inputs[2].collect()]
    assert sorted(r["doc_id"] for r in inputs[3].collect()) == [i for i, _, _, kept in brute_groups(rows, 80, 5) if kept]


def test_rows_without_an_id_of_their_own(spark, sf):
    """Copies whose ids are missing or repeat: one row stays, in either stage."""
    body = " ".join(f"word{k}" for k in range(60))
    near, alone = body + " end", " ".join(f"other{k}" for k in range(60))
    rows = [(None, body), (None, body), (None, near), (None, alone), (7, alone), (7, alone), (8, "x y z"), (8, "x y z"), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(None, 1), (7, 1), (8, 1), (9, 2)]
    kept = Counter(r["doc_id"] for r in P.drop_near_duplicates(spark, df, sf).collect())
    assert sorted(kept.items(), key=str) == sorted(want, key=str)
    left = P.drop_repeated_lines(spark, df.where("coalesce(doc_id, 0) < 8"), sf)
    assert left.columns == df.columns
    # The lines of `body` and `near` differ by more than the distance.
    assert sorted(r["text"] for r in left.collect()) == sorted([body, near, alone])


def test_sources_are_mixed(inputs):
    size = lambda r: len((r["text"] or "").encode().split())
    before, after, largest = Counter(), Counter(), Counter()
    for r in inputs[3].collect():
        before[r["source"]] += size(r)
        largest[r["source"]] = max(largest[r["source"]], size(r))
    for r in inputs[4].collect():
        after[r["source"]] += size(r)
    target = filled(before)
    assert all(abs(after[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_everything_is_packed(inputs):
    docs = [r for r in inputs[4].select("doc_id", "text").collect()]
    once = Counter(r["doc_id"] for r in docs)
    rows = inputs[5].collect()
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == once
    total = sum(r["length"] for r in rows)
    assert total == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    single = inputs[4].dropDuplicates(["doc_id"])
    from tidemark.llm import packing

    round_trip(packing.pack(single, P.vocabulary("word_bpe_49k.json")).collect(), single.collect())


def test_scratch_of_a_stage_goes_when_the_next_begins(spark, sf):
    import os

    docs = staged(spark.read.parquet(f"{sf}/documents.parquet").limit(20), "test-tidy")
    app = spark.sparkContext.applicationId
    stages = dict(P.STAGES)
    lines = stages["line_dedup"](spark, docs, sf)
    scratch = list(P._scratch[app, "line_dedup"])
    there = lambda: [os.path.isdir(p.removeprefix("file:")) for p in scratch]
    assert sum(there()) >= 2
    stages["near_dedup"](spark, lines, sf)  # not written: still read from there
    assert sum(there()) >= 2
    lines = staged(lines, "test-tidy")
    kept = stages["near_dedup"](spark, lines, sf)
    assert not any(there()) and kept.count() == staged(kept, "test-tidy").count() > 0
