"""The segment join against all pairs, the bit-parallel distance against the plain one, and what is dropped."""

import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup as L

SCHEMA = "doc_id long, text string, kept string, n int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, s, edits):
    for _ in range(edits):
        k, c = rng.randrange(len(s) + 1), rng.choice("abcé ")
        s = rng.choice([s[:k] + c + s[k:], s[:k] + s[k + 1:], s[:k] + c + s[k + 1:]])
    return s.strip() or "a"


def brute(rows, d, least):
    lines = {}
    for i, text, *_ in rows:
        for k, x in enumerate((text or "").split("\n")):
            if x := x.strip(L.SPACES):
                lines.setdefault(x, []).append((i, k))
    first = {x: min(v) for x, v in lines.items()}
    link = {x: [y for y in lines if y != x and len(x) >= least and len(y) >= least and abs(len(x) - len(y)) <= d and distance(x, y) <= d] for x in lines}
    out = []
    for x, at in lines.items():
        for p in at:
            kept = len(x) < least or (p == first[x] and all(first[x] <= first[y] for y in link[x]))
            out.append((*p, len(x), *first[x], len(at), len(link[x]), kept))
    return sorted(out)


def test_bit_parallel_distance(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 40)))
        pairs.append((a, edited(rng, a, rng.randrange(6))))
    for d in (1, 2, 3):
        some = [(max(p, key=len), min(p, key=len)) for p in pairs if abs(len(p[0]) - len(p[1])) <= d]
        got = spark.createDataFrame(some, "a string, b string").select("a", "b", (L.edit_distance("a", "b", d) <= d).alias("near")).collect()
        assert len(got) == len(some)
        for r in got:
            assert r["near"] == (distance(r["a"], r["b"]) <= d), (r, d)


def test_all_links_are_found(spark):
    rng = random.Random(7)
    for d, least in ((1, 6), (2, 8), (2, 30)):
        seeds = ["".join(rng.choice("abcde é") for _ in range(rng.randrange(3, 45))).strip() or "x" for _ in range(12)]
        rows = [(k, "\n".join(edited(rng, rng.choice(seeds), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randrange(4))), "clash", 1) for k in range(50)]
        got = L.line_classes(spark.createDataFrame(rows, SCHEMA), d, least).drop("h").collect()
        assert sorted(tuple(r) for r in got) == brute(rows, d, least)


def test_odd_rows(spark):
    long = "word " * 5000
    rows = [(0, None, "k", 1), (1, "", "k", 1), (2, " \n\t\n", "k", 1), (3, long, "k", 1), (4, f"x\n{long}", "k", 1), (5, "short\nshort", "k", 1), (6, "é" * 40 + "\r", "k", 1), (7, "é" * 39, "k", 1)]
    df = spark.createDataFrame([*rows, rows[3]], SCHEMA)
    got = {(r["doc_id"], r["line_no"]): r for r in L.line_classes(df).collect()}
    assert got[3, 0]["kept"] and not got[4, 1]["kept"] and got[4, 1]["first_doc_id"] == 3
    assert got[5, 1]["kept"] and got[6, 0]["n_links"] == 1 and not got[7, 0]["kept"]
    assert L.line_classes(df.limit(0)).count() == 0
    assert L.line_classes(spark.createDataFrame([(None, "a line that is long enough to count", "k", 1), (1, "a line that is long enough to count", "k", 1)], SCHEMA)).where("kept").collect()[0]["doc_id"] is None


def test_lines_are_dropped(spark):
    first, second = "a passage that occurs in several documents", "another line, which is not repeated at all"
    rows = [(1, f"{first}\nx\n{second}", "k", 1), (2, f"y\n  {first}", "k", 2), (3, first.replace("several", "severa"), "k", 3), (4, "", "k", 4), (5, None, "k", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = L.drop_lines(df, L.line_classes(df))
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: rows[0][1], 2: "y", 4: "", 5: None}


def test_large_group_of_equal_lines(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same line in all documents here\nown line of document "), F.format_number("id", 0)).alias("text"))
    got = L.line_classes(df, 1)
    assert got.where("line_no = 0 AND kept").count() == 1 and got.where("line_no = 0").agg(F.min("n_copies")).first()[0] == 3000


def test_few_keys_a_line(spark):
    rows = [(k, "".join(random.Random(k).choice("abcdefgh ") for _ in range(n)), n) for k, n in enumerate(range(30, 330))]
    keys = L.segment_keys(spark.createDataFrame(rows, "h long, line string, n int"), 2)
    many = keys.groupBy("h").count().collect()
    assert len(many) == 300 and {r["count"] for r in many} == {4, 8}
    assert sum(r["count"] for r in many) <= 5.5 * 300


def test_links_across_length_classes(spark):
    rng = random.Random(11)
    for d in (1, 2, 3):
        seeds = ["".join(rng.choice("abcde é") for _ in range(n)).strip() + "x" for n in (28, 31, 32, 33, 63, 64, 65, 71, 72, 79)]
        rows = [(k, "\n".join(edited(rng, rng.choice(seeds), rng.randrange(d + 2)) for _ in range(5)), "clash", 1) for k in range(24)]
        got = L.line_classes(spark.createDataFrame(rows, SCHEMA), d, 20).drop("h").collect()
        want = brute(rows, d, 20)
        assert sorted(tuple(r) for r in got) == want and sum(r[6] for r in want) > 40
