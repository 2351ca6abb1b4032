"""Mixing sources to target weights by capped water-filling.

Sources get weights; each gets that share of the total, clamped at
`max_epochs` times its own size. What is cut off is shared again by weight
among the others until no source is above its clamp. That fixed point is found
in one sorted pass: with sources ordered by clamp / weight, the clamped ones are
a prefix. Repetitions follow: with rep = target / source size, every document is
taken floor(rep) times, and the fractional rest is a seeded sample without
replacement: documents in the order of md5(seed, id) until the missing words are
reached, so that a source misses its target by half a document at most.

Scale: one pass over the texts counts words; then only (id, source, size) rows
move. The seeded order is never sorted as a whole: 4,096 hash buckets a source
are summed, and only the documents of the one bucket in which the cut falls are
ordered. A hot source is therefore spread like any other.

Cases: NULL text has size 0; a NULL source is a source of its own, after all
others; equal or NULL ids are told apart by size, equal rows are interchangeable;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, staged, text_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "tidemark-mix"
_BUCKET_HEX = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with weight and target; one row per source, so sorting them is small."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = (
        sizes.withColumn("weight", F.get(w, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
        .withColumn("clamp", F.col("source_size").cast("double") * max_epochs)
        .withColumn("ratio", F.col("clamp") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("clamp").over(before), F.lit(0.0)))
        .withColumn("share_of", F.sum("weight").over(onward))
    )
    level = F.when(F.col("left") * F.col("weight") <= F.col("clamp") * F.col("share_of"), F.struct("ratio", F.coalesce("source", F.lit("\U0010ffff")).alias("s"), "left", "share_of"))
    return ranked.withColumn("level", F.min(level).over(everything)).select(
        "source", "source_size", "weight",
        F.when(F.col("left") * F.col("weight") <= F.col("clamp") * F.col("share_of"), F.col("level.left") * F.col("weight") / F.col("level.share_of")).otherwise(F.col("clamp")).alias("target"),
    )


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], max_epochs: int, seed: str, carry: bool) -> DataFrame:
    """(id, source, size, source_size, target, copies) per document, with the whole row as `carried` if asked for."""
    sized = staged(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_of(text_col)).alias("size"),
        *[F.struct("*").alias("carried")] * carry,
    ).withColumn("order", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary")))
     .withColumn("bucket", F.substring("order", 1, _BUCKET_HEX)), "mix-sizes")

    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.struct("bucket", (F.col("until") - F.col("words")).alias("before"))
    cut = (
        buckets.withColumn("until", F.sum("words").over(running))
        .join(targets.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .groupBy("source").agg(F.min(F.when(F.col("until") > F.col("rest"), reached)).alias("cut"))
    )
    plan = targets.join(cut.select(F.col("source").alias("s"), "cut"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = staged(plan, "mix-plan").withColumnRenamed("source", "s")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("s")))

    at_cut = F.coalesce(F.col("bucket") == F.col("cut.bucket"), F.lit(False))
    inside = Window.partitionBy("source").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    clear = joined.where(~at_cut).withColumn("extra", F.col("cut").isNull() | (F.col("bucket") < F.col("cut.bucket")))
    tight = joined.where(at_cut).withColumn("before", F.col("cut.before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    tight = tight.withColumn("extra", F.col("before") + F.col("size") / 2 <= F.col("rest")).drop("before")
    copies = (F.col("whole") + F.when(F.col("extra") & (F.col("rest") > 0), 1).otherwise(0)).cast("int")
    return clear.unionByName(tight).select("id", "source", "size", "source_size", "target", copies.alias("copies"), *["carried"] * carry)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies (times taken) and taken (words)."""
    plan = _planned(docs, id_col, text_col, source_col, weights, max_epochs, seed, False)
    return plan.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they are."""
    plan = _planned(docs, id_col, text_col, source_col, weights, max_epochs, seed, True)
    return plan.where("copies > 0").select("carried", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("carried.*")


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
named AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         source_size::DOUBLE * 3 AS clamp, (sum(source_size) OVER ())::DOUBLE AS total FROM named),
levels AS (
  SELECT *, total - coalesce(sum(clamp) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_words,
         sum(weight) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share_of FROM weighed),
water AS (SELECT rest_words AS lw, share_of AS ls FROM levels WHERE rest_words * weight <= clamp * share_of ORDER BY clamp / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN rest_words * weight <= clamp * share_of THEN lw * weight / ls ELSE clamp END AS target
  FROM levels LEFT JOIN water ON true),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
