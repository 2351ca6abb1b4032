"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line of the text. Its leaves are pieces: up to `PIECE`
characters that end, where there is one, at a sentence mark. A paragraph's hash
is the md5 of its leaves' hashes, a section's that of its paragraphs', the root
that of the sections'. A section ends after an empty paragraph, or after one
whose own hash says so (one in eight), so that an edit moves no section border
but those it touches. The fingerprint is text of three parts,

    root : section hashes : leaf hashes

the root in full, the others in their first eight digits; `,` ends a
paragraph and `;` a paragraph that ends its section. Equal roots mean equal texts;
`changed_sections` and `changed_paragraphs` name the branches in which two
fingerprints differ, and `likeness` is the share of leaves they have in common
(1 for equal roots). `branches` gives the tree as rows.

`edits` compares every document with its own text after an edit (its second half
replaced by the start of the next document, by descending id) and with that next
document. Everything here is built-in functions.

Scale: texts are read twice, once for ids, hashes and lengths (which are sorted),
once with their fingerprints; the latter are shuffled once by document and sent
once more, no longer than the edit needs, to the document before.

Cases: NULL text is empty text, whose tree is one empty paragraph. NULL ids come
last; rows of one id are ordered by the md5 of their text; of rows with equal id
and text each is the next of the one before, and the last one's next is the
document that follows. A table of one document is its own next. Texts of any length
are read whole. An empty table gives an empty result; other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import positioned, text_of

PIECE = 200
#: Digits of a hash that a fingerprint keeps for its sections and leaves.
DIGITS = 8
_PIECES = rf"[^.!?。]{{1,{PIECE}}}[.!?。]{{0,8}}|[.!?。]{{1,8}}"
#: First digits of the hash of a paragraph that ends its section.
ENDS = ("0", "8")
_EMPTY = "d41d8cd98f00b204e9800998ecf8427e"  # md5 of nothing: the hash of an empty paragraph
_COPIES = 1_000_000


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


def _mark(h: Column) -> Column:
    return F.when(F.substring(h, 1, 1).isin(*ENDS) | (h == _EMPTY), F.lit(";")).otherwise(F.lit(","))


def with_tree(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with leaves__ (hashes by paragraph), paragraphs__ (hashes), sections__ (their paragraph hashes, as text)."""
    return (
        docs.withColumn("leaves__", F.transform(F.split(text, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(_PIECES), F.lit(0)), _md5)))
        .withColumn("paragraphs__", F.transform("leaves__", lambda x: _md5(F.array_join(x, ""))))
        .withColumn("sections__", F.split(F.array_join(F.transform("paragraphs__", lambda h: F.concat(h, _mark(h))), ""), ";"))
        # The text behind the last mark is empty if the last paragraph ends a section.
        .withColumn("sections__", F.filter("sections__", lambda s: s != ""))
    )


def with_fingerprint(docs: DataFrame, text: Column, name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of `text` (not NULL) as column `name`."""
    hashes = F.transform("sections__", _md5)
    leaves = F.zip_with("leaves__", "paragraphs__", lambda x, h: F.concat(F.array_join(F.transform(x, lambda y: F.substring(y, 1, DIGITS)), ""), _mark(h)))
    return (
        with_tree(docs, text)
        .withColumn("hashes__", hashes)
        .withColumn(name, F.concat(_md5(F.array_join("hashes__", "")), F.lit(":"), F.array_join(F.transform("hashes__", lambda h: F.substring(h, 1, DIGITS)), ""), F.lit(":"), F.array_join(leaves, "")))
        .drop("leaves__", "paragraphs__", "sections__", "hashes__")
    )


def branches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees as rows: (id, section, section_hash, paragraph_hashes), sections numbered from 1."""
    tree = with_tree(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")), F.col("t"))
    each = tree.select(F.col("id").alias(id_col), F.posexplode("sections__").alias("at", "s"))
    return each.select(id_col, (F.col("at") + 1).alias("section"), _md5(F.col("s")).alias("section_hash"), F.filter(F.split("s", ","), lambda h: h != "").alias("paragraph_hashes"))


def root(fp: Column) -> Column:
    return F.split_part(fp, F.lit(":"), F.lit(1))


def _leaves(fp: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.split_part(fp, F.lit(":"), F.lit(3)), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common distinct leaves over all of both; 1 for equal roots."""
    x, y = _leaves(a), _leaves(b)
    both = F.size(x) + F.size(y)
    return F.when(root(a) == root(b), F.lit(1.0)).when(both > 0, F.size(F.array_intersect(x, y)) * 2.0 / both).otherwise(F.lit(0.0))


def _parts(fp: Column, which: str) -> Column:
    text = F.split_part(fp, F.lit(":"), F.lit(3))
    return F.regexp_extract_all(text, F.lit({"sections": "[^;]+;?|;", "paragraphs": "[^,;]*[,;]"}[which]), F.lit(0))


def _missing(a: Column, b: Column, which: str) -> Column:
    bare = lambda p: F.rtrim(p, F.lit(",;")) if which == "paragraphs" else p
    there = F.transform(_parts(b, which), bare)
    marked = F.transform(_parts(a, which), lambda p, i: F.struct(F.array_contains(there, bare(p)).alias("same"), (i + 1).alias("at")))
    return F.transform(F.filter(marked, lambda m: ~m["same"]), lambda m: m["at"])


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 1) of the sections of fingerprint `a` that `b` does not have."""
    return _missing(a, b, "sections")


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 1) of the paragraphs of fingerprint `a` that `b` does not have."""
    return _missing(a, b, "paragraphs")


def _key(id_col: Column, hashed: Column) -> Column:
    """One key for rows of equal id and text, never NULL."""
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("i"), id_col.cast("string")), F.lit("n")), F.lit(" "), hashed).cast("binary"))


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document, its edited text, both fingerprints, and the likeness to the edited and to the next text."""
    named = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("m", _md5(F.col("t"))).withColumn("k", _key(F.col("id"), F.col("m")))
    light = named.groupBy("id", "m", "k", F.length("t").cast("long").alias("n")).agg(F.count("*").alias("c"))
    order = positioned(light, [F.col("id").desc_nulls_last(), F.col("m").asc()], "fingerprint-order")
    total = order.count()
    after = order.select(F.pmod(F.col("position") - 1, F.lit(max(total, 1))).alias("position"), F.col("k").alias("next"))
    follows = order.select("k", "n", "c", "position").join(after, "position").drop("position")

    # One row per id and text; both uses below read one shuffle of the texts.
    texts = with_fingerprint(named.select("id", "t", "k"), F.col("t"), "f").groupBy("k").agg(F.first(F.struct("id", "t", "f")).alias("d"))
    sent = texts.select(F.col("k").alias("next"), "d").join(follows, "next")
    half = F.expr("CAST(n div 2 AS INT)")
    sent = sent.select(F.col("k").alias("to"), "n", "c", F.left(F.col("d.t"), half).alias("start"), F.col("d.f").alias("nf"))
    met = texts.join(sent, F.col("k") == F.col("to")).select(F.col("d.id").alias("id"), F.col("d.t").alias("t"), F.col("d.f").alias("f"), "n", "c", "start", "nf")
    # The last of equal rows is followed by the next document, the others by an equal row.
    last = F.struct(F.col("start").alias("start"), F.col("nf").alias("nf"), F.lit(1).cast("long").alias("times"))
    equal = F.struct(F.left(F.col("t"), half).alias("start"), F.col("f").alias("nf"), (F.col("c") - 1).alias("times"))
    met = met.withColumn("v", F.explode(F.when(F.col("c") > 1, F.array(last, equal)).otherwise(F.array(last))))
    met = met.select("id", "n", "f", "v.nf", "v.times", F.concat(F.left(F.col("t"), F.expr("CAST(n - n div 2 AS INT)")), F.col("v.start")).alias("edited"))
    out = with_fingerprint(met, F.col("edited"), "ef").select(
        F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.col("edited").alias("edited_text"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("f").alias("fingerprint"), F.col("ef").alias("edited_fingerprint"), likeness(F.col("f"), F.col("ef")).alias("near_edited"), likeness(F.col("f"), F.col("nf")).alias("near_next"), "times",
    )
    # Equal rows again, a bounded number at a time.
    out = out.withColumn("b__", F.explode(F.expr(f"sequence(0L, (times - 1) div {_COPIES}L)")))
    return out.withColumn("r__", F.explode(F.expr(f"sequence(1L, least({_COPIES}L, times - b__ * {_COPIES}L))"))).drop("times", "b__", "r__")


def _sql() -> str:
    mark = f"CASE WHEN h[1] IN ({', '.join(repr(e) for e in ENDS)}) OR h = '{_EMPTY}' THEN ';' ELSE ',' END"

    def tree(source: str, text: str, out: str) -> str:
        return f"""
{out}_l AS (SELECT *, [[md5(y) FOR y IN regexp_extract_all(p, '{_PIECES}')] FOR p IN string_split({text}, chr(10))] AS l FROM {source}),
{out}_h AS (SELECT *, [md5(array_to_string(x, '')) FOR x IN l] AS hs FROM {out}_l),
{out}_s AS (SELECT *, [md5(s) FOR s IN string_split(array_to_string([h || {mark} FOR h IN hs], ''), ';') IF s <> ''] AS ss FROM {out}_h),
{out} AS (SELECT * EXCLUDE (l, hs, ss), md5(array_to_string(ss, '')) || ':' || array_to_string([s[1:{DIGITS}] FOR s IN ss], '') || ':' ||
   array_to_string([array_to_string([x[1:{DIGITS}] FOR x IN l[i]], '') || [{mark} FOR h IN [hs[i]]][1] FOR i IN range(1, len(l) + 1)], '') AS {out}_fp FROM {out}_s)"""

    leaves = lambda fp: f"list_distinct(regexp_extract_all(split_part({fp}, ':', 3), '[0-9a-f]{{{DIGITS}}}'))"

    def like(a: str, b: str) -> str:
        x, y = leaves(a), leaves(b)
        return f"""CASE WHEN split_part({a}, ':', 1) = split_part({b}, ':', 1) THEN 1.0::DOUBLE WHEN len({x}) + len({y}) > 0
   THEN len(list_intersect({x}, {y})) * 2.0::DOUBLE / (len({x}) + len({y})) ELSE 0.0::DOUBLE END"""

    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),{tree('texts', 't', 'own')},
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(t)) AS r FROM own),
followed AS (SELECT a.*, b.t AS nt, b.own_fp AS next_fp FROM numbered a JOIN numbered b ON b.r = a.r % (SELECT count(*) FROM numbered) + 1),
edited AS (SELECT *, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2) AS e FROM followed),{tree('edited', 'e', 'changed')}
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(e) AS edited_sha256, own_fp AS fingerprint, changed_fp AS edited_fingerprint,
  {like('own_fp', 'changed_fp')} AS near_edited, {like('own_fp', 'next_fp')} AS near_next
FROM changed
"""


SQL = _sql()
