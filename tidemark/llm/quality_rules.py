"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets a few integer measures in one pass of built-in functions.
A quantile sketch per (language, source, measure) is a histogram of fixed bins,
so merging two sketches adds their counts: Spark merges them map-side, then
per source, and again per language. Thresholds are Tukey fences read off the
sketch (quartile plus or minus `REACH` times the spread of the quartiles, plus
a slack of some bins), in place of fixed cutoffs. A (language, source) pair
with under `MIN_ROWS` documents uses the merged sketch of its language. The
thresholds are joined back to the documents, which are kept if they pass the
base rules and lie inside all fences.

Scale: texts are read once; the measures (a few numbers per document) are
staged, the sketches hold at most some thousand bins a group, and no window or
join needs the rows of a group in one task.

Cases: NULL text has no words and fails the base rule; NULL language or source
form groups of their own; repeated rows count each; an empty table gives an
empty result; other columns are not looked at. Word windows are compared by a
64-bit hash, found by sorting hash prefixes that carry their position, so a text
of any length up to 16 million words costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, staged, text_of

SYMBOLS = "#*$%&|<>"
MIN_ROWS = 50
REACH = 3
MIN_WORDS = 50
#: measure -> (numerator, denominator, scale of a bin, slack in bins, which fences)
MEASURES = {
    "word_length": ("word_chars", "n_words", 10, 10, "both"),
    "symbols": ("n_symbols", "word_chars", 1000, 30, "upper"),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 200, "upper"),
    "repeats": ("n_repeat_words", "n_words", 1000, 200, "upper"),
    "capitals": ("n_capitals", "word_chars", 1000, 100, "upper"),
}
_POS_BITS = 24


def _occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: str) -> Column:
    """Words of array column `words` that lie in a 3-word window seen twice or more.

    Window hashes are sorted with their position in the low bits; neighbours
    with the same high bits are then compared by the whole hash.
    """
    return F.expr(f"""
      CASE WHEN size({words}) < 4 THEN 0L ELSE
        aggregate(array(transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i+1], {words}[i+2]))), 0L, (z, h) ->
          aggregate(array(sort_array(transform(h, (x, i) -> shiftleft(shiftright(x, {_POS_BITS}), {_POS_BITS}) | CAST(i AS BIGINT)))), 0L, (y, p) ->
            CAST(size(array_distinct(flatten(transform(
              filter(p, (x, k) ->
                (k > 0 AND h[CAST(x & {(1 << _POS_BITS) - 1} AS INT)] = h[CAST(p[k-1] & {(1 << _POS_BITS) - 1} AS INT)]) OR
                (k + 1 < size(p) AND h[CAST(x & {(1 << _POS_BITS) - 1} AS INT)] = h[CAST(p[k+1] & {(1 << _POS_BITS) - 1} AS INT)])),
              x -> array(x & {(1 << _POS_BITS) - 1}, (x & {(1 << _POS_BITS) - 1}) + 1, (x & {(1 << _POS_BITS) - 1}) + 2))))) AS BIGINT)))
      END""")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    spaces_out = F.translate(F.col("t"), SPACES, " " * len(SPACES))
    return (
        docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("t"))
        .withColumn("w", F.expr("filter(split(t, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x != '')"))
        .withColumn("l", F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
        .select(
            "id", "lang", "source",
            F.size("w").cast("long").alias("n_words"),
            F.length(F.replace(spaces_out, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
            _occurrences(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
            (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
            repeated_words("w").alias("n_repeat_words"),
            F.size("l").cast("long").alias("n_lines"),
            _occurrences(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
        )
    )


def _bin(measure: str) -> Column:
    num, den, scale, _, _ = MEASURES[measure]
    return F.when(F.col(den) > 0, F.expr(f"({num} * {scale}) div {den}"))


def sketches(measured: DataFrame) -> DataFrame:
    """Histogram sketch: (lang, source, measure, bin) -> rows. Merge by adding."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _bin(m).alias("bin")) for m in MEASURES]))
    return measured.select("lang", "source", each.alias("e")).where(F.col("e.bin").isNotNull()).groupBy("lang", "source", F.col("e.measure").alias("measure"), F.col("e.bin").alias("bin")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper fence of every measure, one row per group of `keys`."""
    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("until", F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))).withColumn("rows", F.sum("n").over(group))
    quartile = lambda q: F.min(F.when(F.col("until") * 4 >= F.col("rows") * q, F.col("bin")))
    by_measure = ranked.groupBy(*keys, "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("rows").alias("rows"))
    slack = F.create_map(*[F.lit(x) for m, v in MEASURES.items() for x in (m, v[3])])[F.col("measure")]
    spread = (F.col("q3") - F.col("q1")) * REACH + slack
    both = F.col("measure").isin([m for m, v in MEASURES.items() if v[4] == "both"])
    fence = F.struct(F.when(both, F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper"))
    return by_measure.groupBy(*keys).agg(F.max("rows").alias("rows"), *[F.max(F.when(F.col("measure") == m, fence)).alias(f"f_{m}") for m in MEASURES])


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per document with measures, `base_failed`, the fences passed or not, and `kept`."""
    measured = staged(measures(docs, id_col, text_col, lang_col, source_col), "quality-measures")
    sketch = staged(sketches(measured), "quality-sketches")
    names = [f"f_{m}" for m in MEASURES]
    own = fences(sketch, ["lang", "source"]).where(F.col("rows") >= min_rows)
    merged = fences(sketch, ["lang"])
    pairs = sketch.select("lang", "source").distinct()
    chosen = pairs.join(own.select(F.col("lang").alias("l1"), F.col("source").alias("s1"), *[F.col(n).alias(f"own_{n}") for n in names]), F.col("lang").eqNullSafe(F.col("l1")) & F.col("source").eqNullSafe(F.col("s1")), "left")
    chosen = chosen.join(merged.select(F.col("lang").alias("l2"), *names), F.col("lang").eqNullSafe(F.col("l2")), "left")
    chosen = staged(chosen.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), *[F.coalesce(f"own_{n}", n).alias(n) for n in names]), "quality-fences")
    inside = F.lit(True)
    for m in MEASURES:
        b, f = _bin(m), F.col(f"f_{m}")
        inside = inside & F.coalesce((F.coalesce(b >= f["lower"], F.lit(True))) & (b <= f["upper"]), F.lit(True))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        measured.join(chosen, F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs")), "left")
        .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & inside).alias("kept"))
    )


def _sql() -> str:
    has = r"regexp_matches(x, '[^\x20\x09-\x0D]')"
    bins = {m: f"CASE WHEN {v[1]} > 0 THEN ({v[0]} * {v[2]}) // {v[1]} END" for m, v in MEASURES.items()}
    each = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {b} AS bin FROM measured" for m, b in bins.items())
    slack = "CASE measure " + " ".join(f"WHEN '{m}' THEN {v[3]}" for m, v in MEASURES.items()) + " END"
    both = ", ".join(f"'{m}'" for m, v in MEASURES.items() if v[4] == "both")

    def fence(keys: str) -> str:
        return f"""
  SELECT {keys}, measure, max(rows) AS rows,
         CASE WHEN measure IN ({both}) THEN min(bin) FILTER (until * 4 >= rows) - (min(bin) FILTER (until * 4 >= rows * 3) - min(bin) FILTER (until * 4 >= rows)) * {REACH} - {slack} END AS lo,
         min(bin) FILTER (until * 4 >= rows * 3) + (min(bin) FILTER (until * 4 >= rows * 3) - min(bin) FILTER (until * 4 >= rows)) * {REACH} + {slack} AS hi
  FROM (SELECT {keys}, measure, bin, sum(n) OVER (PARTITION BY {keys}, measure ORDER BY bin) AS until, sum(n) OVER (PARTITION BY {keys}, measure) AS rows
        FROM (SELECT {keys}, measure, bin, count(*) AS n FROM each WHERE bin IS NOT NULL GROUP BY ALL)) GROUP BY {keys}, measure"""

    return rf"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                      [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF {has}] AS l, row_number() OVER () AS r FROM documents),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM texts WHERE len(w) >= 3),
seen AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM windows),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM seen WHERE times > 1) GROUP BY r),
measured AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM texts LEFT JOIN covered c USING (r)),
each AS ({each}),
own AS ({fence("lang, source")}),
merged AS ({fence("lang")}),
own_pairs AS (SELECT lang, source, max(rows) AS rows FROM own GROUP BY ALL),
judged AS (
  SELECT m.*, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * 50 AS base_failed,
         (SELECT count(*) FROM (SELECT unnest([{", ".join(f"'{m}'" for m in MEASURES)}]) AS k, unnest([{", ".join(bins.values())}]) AS v) q
          WHERE q.v IS NOT NULL AND EXISTS (
            SELECT 1 FROM (
              SELECT measure, lo, hi FROM own o WHERE o.rows >= 0 AND o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source
                 AND (SELECT p.rows FROM own_pairs p WHERE p.lang IS NOT DISTINCT FROM m.lang AND p.source IS NOT DISTINCT FROM m.source) >= {MIN_ROWS}
              UNION ALL
              SELECT measure, lo, hi FROM merged g WHERE g.lang IS NOT DISTINCT FROM m.lang
                 AND (SELECT p.rows FROM own_pairs p WHERE p.lang IS NOT DISTINCT FROM m.lang AND p.source IS NOT DISTINCT FROM m.source) < {MIN_ROWS}) f
            WHERE f.measure = q.k AND (q.v < f.lo OR q.v > f.hi))) AS outside
  FROM measured m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND outside = 0 AS kept FROM judged
"""


SQL = _sql()
