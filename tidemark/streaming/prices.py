"""The weekday price job as an incremental Structured Streaming query.

The stored ticks are a file stream: each run (`trigger(availableNow=True)`, a
scheduled batch with exactly-once bookkeeping in the checkpoint) reads only the new
files, folds them into the store of daily sums (`operators.partials`) and
recomputes the months or years they touch. A micro-batch that is
repeated overwrites its own part of the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import partials as P
from tidemark.schemas import TICK, aggregate_schema


def tick_stream(spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ticks from a folder of files, with the explicit TICK schema.

    New files land in the folder itself or in partition-style subfolders
    (`drop=<n>/`); other subfolders are not listed by the file source.
    """
    r = spark.readStream.format(fmt).schema(TICK)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_incremental(spark: SparkSession, source: str, store: str, target: str, checkpoint: str, grain: str = "monthly",
                    fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """One scheduled run: folds the new tick files into store and target; returns the target."""

    def batch(ticks: DataFrame, number: int) -> None:
        P.fold(ticks, store, number)
        P.refresh(spark, store, number, target, grain)

    q = (tick_stream(spark, source, fmt, max_files_per_trigger).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(batch).trigger(availableNow=True).start())
    q.awaitTermination()
    keys = [P.STORE[k] for k in P.GRAIN_KEYS[grain]]
    return spark.read.schema(aggregate_schema(keys)).parquet(target)
