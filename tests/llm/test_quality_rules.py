"""Measures against plain Python, sketches that merge, and what the fences keep."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm import quality_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words string"


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(9)
    out = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "x x x x x", "é ß 日本 😀 a", "l\nl\n\nl \nl", "#*$ %&|<> \x0b\x0c\r end"]
    return out + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)] + ["w1 w2 w3 " * 3000, "A" * 5000]


def test_measures(spark):
    rows = [(k, t, [None, "en"][k % 2], "s", "clash") for k, t in enumerate(texts())]
    df = spark.createDataFrame([*rows, rows[5]], SCHEMA)
    got = R.apply_rules(df).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        want = plain(rows[r["doc_id"]][1])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, rows[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert R.apply_rules(df.limit(0)).count() == 0


def test_sketches_merge(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    measured = R.measures(docs).cache()
    whole = R.sketches(measured)
    halves = R.sketches(measured.where("id % 2 = 0")).unionByName(R.sketches(measured.where("id % 2 = 1"))).groupBy("lang", "source", "measure", "bin").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(halves.select(whole.columns)).count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.op8_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] > 0.99 and kept[0] < 0.35
