"""The corpus pipeline: documents in, packed training sequences out.

Stages, in order: toxic documents go; lines that occurred before go, and
documents of which nothing is left; one document of each group of near
duplicates stays; sources are mixed to their target weights (a document may then
occur up to three times); what is left is packed into sequences. Each stage
takes all that the one before kept, and its result is written as Parquet to the
shared checkpoint folder and read again, so that a lost executor repeats one
stage at most. Nobody reads what a stage staged on its way once its result is
written: the next stage removes it first. So in one application a stage is called
only when the result of the one before, if it was called too, has been written.

Empty texts, and tables without rows, go through every stage: an empty text is
not toxic, has no lines, is nobody's duplicate, is repeated by the mix as its
place in its source's order says, and packs to its end token. A NULL text counts
as empty, a NULL source is a source of its own; other columns are carried along.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, near_dedup, packing, toxicity
from tidemark.llm.common import collected, remainder, remove, staged, table
from tidemark.llm.queries import vocabulary

#: Near duplicates: word shingles of five, similarity 0.8.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return toxicity.reject(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, PERCENT, SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders staged by the last call of each stage, by application and stage.
_scratch: dict[tuple[str, str], list[str]] = {}


def tidy(name: str, before: str | None, stage: Stage) -> tuple[str, Stage]:
    """The stage, which first removes what the one before had staged; not if its input still reads from there."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        done = _scratch.get((app, before), []) if before else []
        files = docs.inputFiles() if done else []
        if files and not {part for file in files for part in file.split("/")} & {os.path.basename(path) for path in done}:
            for path in _scratch.pop((app, before)):
                remove(spark, path)
        with collected() as paths:
            out = stage(spark, docs, sf_dir)
        _scratch[app, name] = paths
        return out

    return name, run_stage


STAGES = [
    tidy("toxicity", None, drop_toxic),
    tidy("line_dedup", "toxicity", drop_repeated_lines),
    tidy("near_dedup", "line_dedup", drop_near_duplicates),
    tidy("mixing", "near_dedup", mix_sources),
    tidy("packing", "mixing", pack_sequences),
]

#: Training and packing are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
