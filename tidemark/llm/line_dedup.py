"""Near-duplicate lines by a segment-partition edit join, in built-in functions only.

Lines are the \\n-split pieces of a text, trimmed of white space, that have a
character left. Equal lines form a class, named by a 64-bit hash; its first line
is the one with the smallest (id, line number). Classes of `MIN_CHARS`
characters or more are linked when their edit distance is `DISTANCE` (d) or less:

* lengths are dealt into short classes, each with d + 1 segments for the lines of
  its lengths and of up to d more, so that two lines of nearly equal length share a
  class: a line is in one class, or in two where it is among the shortest of its own.
  Segments of the first half have their places from the line's start, others from its
  end; the index has (class, segment number, segment) of every line;
* of d + 1 segments d edits must leave one whole, with i edits before segment i and
  at most d - i behind it, so that it lies at most that far from its place in the
  other line, where a line probes for it. With d = 2 only the middle one
  can shift, by one, and in one of the two lines it then lies one later: each line
  probes for that;
* keys that meet no other line are dropped first; of what is left,
  pairs that meet are dropped if their lengths and the counts of their letters differ
  by more than d edits can explain, and verified by a banded bit-parallel edit distance:
  per column, the 2 d + 1 cells around the diagonal are a few bits of one integer.

A line of `MIN_CHARS` or more is kept if it is the first of its class and its
class is not linked to one whose first line comes before. Shorter lines say too
little to be called copies; they are always kept.

Scale: texts are split once, and the lines written. No text is shuffled for lines
that occur once and meet no other: classes are found by hash with map-side sums, keys
are made in the scan of the lines, and only lines that occur twice, or meet another,
send their text. Keys and
hashes are spread evenly; a line that fills a third of the table is one class
before any join, and its rows meet that class in a join Spark can split.

Cases: NULL, empty and blank texts have no lines and give no rows; rows that
repeat an id and a text repeat their result; a missing id comes first; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, SPACES, discard, numbered, possibly_in, staged, text_of

DISTANCE = 2
MIN_CHARS = 30
#: Frequent letters of Latin scripts, nine to an integer; any would be right, frequent ones tell more.
LETTERS = ("eantrsiol", "hdcumpbgf")


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (
        docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(text_of(text_col), "\n")).alias("line_no", "line"))
        .withColumn("line", F.btrim("line", F.lit(SPACES))).where("line != ''")
        .withColumn("h", F.xxhash64("line", F.length("line"))).withColumn("n", F.length("line"))
    )


def letter_counts(letters: str) -> Column:
    """Nine counts, each modulo 128, in one integer. An ASCII letter taken out is a byte less."""
    packed = F.lit(0).cast("long")
    for k, c in enumerate(letters):
        packed = packed + F.shiftleft((F.octet_length("line") - F.octet_length(F.replace("line", F.lit(c)))).cast("long") % 128, 7 * k)
    return packed


def _letters_apart(a: str, b: str) -> str:
    """SQL: the sum of the differences of the counts; an edit changes it by two at most."""
    each = []
    for k in range(len(LETTERS[0])):
        gap = f"abs((shiftright({a}, {7 * k}) & 127) - (shiftright({b}, {7 * k}) & 127))"
        each.append(f"least({gap}, 128 - {gap})")
    return " + ".join(each)


def probes(d: int) -> list[tuple[int, int]]:
    """(segment, how far from its place in this line it is looked for); 0 is the line's own segment too."""
    return [(i, shift) for i in range(d + 1) for most in [min(i, d - i)] for shift in range(0 if d == 2 else -most, most + 1)]


def _class(n: str, d: int) -> str:
    """SQL: the least length of the class of length n; classes are wider than d, so that n and n - d are in neighbours at most."""
    w = max(4, d + 1)
    return f"{n} - {n} % CASE WHEN {n} < {16 * w} THEN {w} ELSE {2 * w} END"


def segment_keys(texts: DataFrame, d: int) -> DataFrame:
    """(key, h, whole): index rows (whole) and further probes of every line (h, line, n)."""
    spec = lambda classes: F.array(*[F.struct(F.lit(low).alias("low"), F.lit(i).alias("i"), F.lit(shift).alias("shift")) for low in classes for i, shift in probes(d)])
    dealt = texts.select("h", "line", "n", F.expr(_class("n", d)).alias("own"), F.expr(_class(f"greatest(n - {d}, 0)", d)).alias("lower"))
    each = dealt.select("h", "line", "n", "own", "lower", F.explode(F.when(F.col("own") == F.col("lower"), spec([False])).otherwise(spec([False, True]))).alias("p"))
    each = each.select("h", "line", "n", "p.i", "p.shift", F.expr("CASE WHEN p.low THEN lower ELSE own END").alias("m"))
    start = f"i * (m div {d + 1}) + greatest(0, i - ({d + 1} - m % {d + 1})) + shift + CASE WHEN 2 * i > {d} THEN n - m ELSE 0 END"
    size = f"m div {d + 1} + CASE WHEN i >= {d + 1} - m % {d + 1} THEN 1 ELSE 0 END"
    return each.select(F.expr(f"xxhash64(m, i, substring(line, CAST({start} + 1 AS INT), CAST({size} AS INT)))").alias("key"), "h", F.expr("shift = 0").alias("whole"))


def edit_distance(a: str, b: str, d: int) -> Column:
    """Banded bit-parallel edit distance of columns `a` and `b` (length of a from length of b to d more); right if at most d, else over d.

    Bit k of a column j stands for row j - d + k; vp and vn have the cells that
    are one more or less than the cell above. The distance is followed along
    the diagonal that ends in the last cell.
    """
    mask = (1 << (2 * d + 1)) - 1
    match = " | ".join(f"(CASE WHEN get(x, j - {d} + {k} - 1) = y[j - 1] THEN {1 << k} ELSE 0 END)" for k in range(2 * d + 1))
    d0 = "((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn)"
    hp = f"(s.vn | ~({d0} | s.vp))"
    hn = f"({d0} & s.vp)"
    down = f"shiftright({d0} & {mask}, 1)"
    step = (f"named_struct('vp', ({hn} | ~({down} | {hp})) & {mask}, 'vn', ({down} & {hp}) & {mask}, "
            f"'e', s.e + CASE WHEN (shiftright({d0}, {d} + s.off) & 1) = 1 THEN 0 ELSE 1 END, 'off', s.off)")
    begin = f"named_struct('vp', {mask ^ ((1 << d) - 1)}, 'vn', 0, 'e', size(x) - size(y), 'off', size(x) - size(y))"
    return F.expr(f"""
      aggregate(array(named_struct('x', split({a}, ''), 'y', split({b}, ''))), {d + 1}, (z, t) ->
        aggregate(transform(array(t.x), x -> transform(array(t.y), y ->
          aggregate(transform(sequence(1, size(y)), j -> {match}), {begin}, (s, m) -> {step}).e))[0], 0, (u, v) -> u + v))""")


def linked_classes(texts: DataFrame, repeated: DataFrame, d: int) -> DataFrame:
    """Pairs (a, b) of classes within `d` edits; `texts` are lines (h, line, n), `repeated` the classes (h) with several lines."""
    once = ["h", "line", "n"]
    # Lines of repeated classes are taken once; all others are single and need no shuffle.
    some = possibly_in(texts, "h", repeated, "h").dropDuplicates(["h"]).select(once)
    single = possibly_in(texts, "h", repeated, "h", keep=False).select(once)
    keyed = staged(segment_keys(single.unionByName(some), d), "line-keys")
    # Most keys meet nothing: only those with an index row and a row of another line go on.
    met = keyed.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.max("whole").alias("indexed")).where("lo != hi AND indexed").select("key")
    meeting = staged(keyed.join(met, "key", "left_semi"), "line-meeting")
    discard(keyed)
    involved = meeting.select(F.col("h").alias("x")).distinct()
    counts = [letter_counts(x).alias(c) for c, x in zip("fg", LETTERS, strict=True)]
    known = staged(possibly_in(texts, "h", involved, "x").join(involved, F.col("h") == F.col("x"), "left_semi").dropDuplicates(["h"]).select("h", "line", "n", *counts), "line-texts")
    marked = staged(meeting.join(known.drop("line"), "h"), "line-marked")
    index = marked.where("whole").select("key", *[F.col(c).alias(x) for c, x in (("h", "a"), ("n", "na"), ("f", "fa"), ("g", "ga"))])
    probe = marked.select("key", *[F.col(c).alias(x) for c, x in (("h", "b"), ("n", "nb"), ("f", "fb"), ("g", "gb"))], "whole")
    near = F.expr(f"(a < b OR (a > b AND NOT whole)) AND abs(na - nb) <= {d} AND {_letters_apart('fa', 'fb')} + {_letters_apart('ga', 'gb')} <= {2 * d}")
    pairs = staged(index.join(probe, "key").where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    discard(meeting, marked)
    both = pairs.join(known.select("h", "line", "n").toDF("a", "la", "na"), "a").join(known.select("h", "line", "n").toDF("b", "lb", "nb"), "b")
    longer, shorter = F.when(F.col("na") >= F.col("nb"), F.col("la")).otherwise(F.col("lb")), F.when(F.col("na") >= F.col("nb"), F.col("lb")).otherwise(F.col("la"))
    both = both.select("a", "b", longer.alias("long"), shorter.alias("short"))
    links = staged(both.where(edit_distance("long", "short", d) <= d).select("a", "b"), "line-links")
    discard(pairs, known)
    return links


def line_classes(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line: id, line_no, n_chars, first_<id> and first_line of its class, n_copies, n_links (other classes within `distance`), kept, h."""
    # Split once: short lines are never compared, and leave only their places.
    here = staged(lines(docs, id_col, text_col).select("id", "line_no", "n", "h", F.when(F.col("n") >= min_chars, F.col("line")).alias("line")), "line-places")
    texts = here.where(F.col("n") >= min_chars).select("h", "line", "n")
    classes = staged(here.groupBy("h").agg(F.min(F.struct("id", "line_no")).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n")), "line-classes")
    links = linked_classes(texts, classes.where((F.col("copies") > 1) & (F.col("n") >= min_chars)).select("h"), distance)
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    earliest = ways.join(classes.select("h", F.col("first").alias("other")), F.col("b") == F.col("h")).groupBy(F.col("a").alias("linked")).agg(F.count("*").alias("n_links"), F.min("other").alias("before"))
    classes = classes.join(earliest, F.col("h") == F.col("linked"), "left").withColumn("leads", F.coalesce(F.col("first") <= F.col("before"), F.lit(True)))
    out = here.join(classes.select(F.col("h").alias("c"), "first", "copies", "n_links", "leads"), F.col("h") == F.col("c"))
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("line_no") == F.col("first.line_no"))
    return out.select(
        F.col("id").alias(id_col), "line_no", F.col("n").alias("n_chars"), F.col("first.id").alias(f"first_{id_col}"), F.col("first.line_no").alias("first_line"),
        F.col("copies").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), ((F.col("n") < min_chars) | (is_first & F.col("leads"))).alias("kept"), "h")


def drop_lines(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines that are not kept; a document that had lines and has none left is dropped."""
    gone = classes.where("NOT kept").groupBy(F.col(id_col).alias("gone_id")).agg(F.collect_set(F.struct("line_no", "h")).alias("gone"))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col("gone_id")), "left")
    trimmed = f"btrim(x, '{SPACES}')"
    left = F.expr(f"filter(split(`{text_col}`, '\\n'), (x, k) -> NOT array_contains(gone, named_struct('line_no', k, 'h', xxhash64({trimmed}, length({trimmed})))))")
    text = F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    changed = joined.withColumn(text_col, text)
    return changed.where(F.col("gone").isNull() | (F.btrim(F.col(text_col), F.lit(SPACES)) != "")).select(docs.columns)


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without lines that occurred before, by id and, where ids are missing or repeat, by row."""
    rows = numbered(docs, "line-rows")
    keyed = rows.select(F.struct(F.col(id_col).alias("id"), F.col(ROW).alias("r")).alias("place"), text_col)
    classes = line_classes(keyed, id_col="place", text_col=text_col).select(F.col("place.r").alias(ROW), "line_no", "h", "kept")
    return drop_lines(rows, classes, ROW, text_col).select(docs.columns)


_TRIM = "trim(x.raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL = f"""
WITH pieces AS (
  SELECT doc_id, unnest(range(0, len(l))) AS line_no, l FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
trimmed AS (SELECT doc_id, line_no::INT AS line_no, {_TRIM} AS line FROM (SELECT doc_id, line_no, l[line_no + 1] AS raw FROM pieces) x),
here AS (SELECT *, length(line) AS n FROM trimmed WHERE line != ''),
classes AS (SELECT line, any_value(n) AS n, min((doc_id, line_no)) AS first, count(*) AS copies FROM here GROUP BY line),
-- The edit distance counts characters: every other script's letter stands for one byte here.
plain AS (
  SELECT line, n, first, regexp_replace(line, '[^\\x00-\\x7F]', chr(1), 'g') AS ascii, length(replace(line, 'e', '')) AS e, length(replace(line, 'a', '')) AS a,
         length(replace(line, 'n', '')) AS o, length(replace(line, 't', '')) AS t FROM classes WHERE n >= {MIN_CHARS}),
-- {DISTANCE} edits change the number of characters that are not a given letter by {DISTANCE} at most.
close AS (
  SELECT p.line AS la, q.line AS lb, p.first AS fa, q.first AS fb
  FROM plain p JOIN (SELECT *, unnest(range(n, n + {DISTANCE} + 1)) AS m FROM plain) q ON p.n = q.m AND (p.n > q.n OR p.line < q.line)
  WHERE CASE WHEN abs(p.e - q.e) <= {DISTANCE} AND abs(p.a - q.a) <= {DISTANCE} AND abs(p.o - q.o) <= {DISTANCE} AND abs(p.t - q.t) <= {DISTANCE} THEN levenshtein(p.ascii, q.ascii) <= {DISTANCE} ELSE false END),
chars AS (SELECT *, string_split(la, '') AS x, string_split(lb, '') AS y FROM close WHERE regexp_matches(la || lb, '[^\\x00-\\x7F]')),
exact AS (
  SELECT la, lb, fa, fb FROM close WHERE NOT regexp_matches(la || lb, '[^\\x00-\\x7F]')
  UNION ALL
  SELECT la, lb, fa, fb FROM chars WHERE levenshtein(
    array_to_string([chr((list_position(list_sort(list_distinct(x || y)), c) + 1)::INT) FOR c IN x], ''),
    array_to_string([chr((list_position(list_sort(list_distinct(x || y)), c) + 1)::INT) FOR c IN y], '')) <= {DISTANCE}),
ways AS (SELECT la AS line, fb AS other FROM exact UNION ALL SELECT lb, fa FROM exact),
linked AS (SELECT line, count(*) AS n_links, min(other) AS before FROM ways GROUP BY line)
SELECT h.doc_id, h.line_no, h.n::INT AS n_chars, c.first[1] AS first_doc_id, c.first[2] AS first_line, c.copies AS n_copies, coalesce(k.n_links, 0)::BIGINT AS n_links,
       h.n < {MIN_CHARS} OR ((h.doc_id, h.line_no) = c.first AND (k.before IS NULL OR c.first <= k.before)) AS kept
FROM here h JOIN classes c USING (line) LEFT JOIN linked k USING (line)
"""
