"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, fingerprints, hard_negatives, line_dedup, lm_score, mixing, near_dedup, packing, quality_knn, quality_rules, token_counts, toxicity, whitening
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.split_scores(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents")).drop("h")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, F.col("vec_id") % 100 == 0)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_long(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents")).drop("edited_text")


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_lm_score, op2_line_dedup, op3_near_dedup, op4_ann, op5_source_mixing, op6_toxicity, op7_packing, op8_quality_rules, op9_token_counts, op10_quality_knn, op11_hard_negatives, op12_whitening, op13_fingerprints)}


def registry_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.SQL, "op3_near_dedup": near_dedup.SQL, "op5_source_mixing": mixing.SQL, "op8_quality_rules": quality_rules.SQL, "op11_hard_negatives": hard_negatives.SQL, "op13_fingerprints": fingerprints.SQL}
