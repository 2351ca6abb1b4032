"""Merkle trees against a plain-Python tree, edits against a plain loop, odd rows."""

import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import fingerprints as P

PIECES = re.compile(r"[^.!?。]{1,200}[.!?。]{0,8}|[.!?。]{1,8}")
SCHEMA = "doc_id long, text string, position string, k int, fingerprint string"


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def plain(text):
    leaves = [[md5(x) for x in PIECES.findall(p)] for p in text.split("\n")]
    hashes = [md5("".join(x)) for x in leaves]
    ends = [h[0] in "08" or h == md5("") for h in hashes]
    sections, now = [], ""
    for h, end in zip(hashes, ends):
        now += h + ("" if end else ",")
        if end:
            sections.append(now)
            now = ""
    if now:
        sections.append(now)
    tops = [md5(s) for s in sections]
    return md5("".join(tops)) + ":" + "".join(t[:8] for t in tops) + ":" + "".join("".join(y[:8] for y in x) + (";" if e else ",") for x, e in zip(leaves, ends))


def like(a, b):
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    x, y = (set(re.findall("[0-9a-f]{8}", s.split(":")[2])) for s in (a, b))
    return 2.0 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), md5(r[1] or "")))
    out = []
    for k, (doc, text) in enumerate(order):
        t, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[:h]
        f, ef, nf = plain(t), plain(e), plain(nxt)
        out.append((doc, len(t), hashlib.sha256(e.encode()).hexdigest(), f, ef, like(f, ef), like(f, nf)))
    return sorted(out, key=repr)


def rows():
    lines = [f"Line {k} tells of {k * k}. It ends here! Or does it?" for k in range(60)]
    return [
        (1, None), (2, ""), (3, "a"), (4, "ab"), (5, "\n\n"), (6, "one line without any mark"), (7, "é😀日本。" * 90), (8, "\n".join(lines)),
        (9, "\n".join(lines)), (10, "\n".join(lines[:30] + ["changed"] + lines[30:])), (11, "x" * 1001 + "\n" + "." * 30), (12, "long. " * 60_000 + "\n" + "no mark " * 20_000),
        (None, "no id"), (None, "no id"), (None, "no id"), (None, "other"), (8, "same id, other text"), (4, "ab"), (4, "ab"), (-3, "below zero\r\n\tend "), (13, "\n".join(reversed(lines))),
    ]


def frame(spark, some):
    return spark.createDataFrame([(d, t, "clash", 1, "clash") for d, t in some], SCHEMA).repartition(3)


def test_edits_match_a_plain_loop(spark):
    got = P.edits(frame(spark, rows())).drop("edited_text").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows())


def test_one_row_and_no_rows(spark):
    only = [(5, "Alone. With itself.")]
    assert [tuple(r) for r in P.edits(frame(spark, only)).drop("edited_text").collect()] == brute(only)
    assert P.edits(frame(spark, [])).count() == 0
    assert P.branches(frame(spark, [])).count() == 0


def test_many_equal_rows(spark):
    some = [(7, "the same. text")] * 500 + [(None, "")] * 300 + [(1, "end")]
    got = P.edits(frame(spark, some)).drop("edited_text").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(some)


def test_branches_locate_an_edit(spark):
    lines = [f"Paragraph {k}, which says {k * 7919}." for k in range(200)]
    edited = lines[:100] + ["Paragraph 100 was rewritten."] + lines[101:]
    df = P.with_fingerprint(P.with_fingerprint(spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "a string, b string"), F.col("a"), "fa"), F.col("b"), "fb")
    r = df.select("fa", P.changed_paragraphs(F.col("fa"), F.col("fb")).alias("p"), P.changed_sections(F.col("fa"), F.col("fb")).alias("s"), P.likeness(F.col("fa"), F.col("fb")).alias("like")).first()
    assert r["p"] == [101] and 1 <= len(r["s"]) <= 2 and r["like"] > 0.99
    tree = P.branches(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).orderBy("section").collect()
    assert sum(len(x["paragraph_hashes"]) for x in tree) == 200
    assert md5("".join(x["section_hash"] for x in tree)) == r["fa"].split(":")[0]


def test_native(spark):
    plan = P.edits(frame(spark, rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InPandas|InArrow|ExistingRDD.*Python", plan)
