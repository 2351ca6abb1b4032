"""A store of mergeable daily sums, and averages rolled up from it (A2, A3 between runs).

Each run folds its new ticks to one row of exact sum states per day and ticker
(`functions.exact`) and adds them to a Parquet store partitioned by `Year`, `Month`
and `batch`. Averages of a month are the merged states of that month's
partitions, those of a year of that year's, so a run reads and rewrites only
the months and years its ticks fall in, and the result equals, to the last bit, the
averages of all ticks ever folded.

A batch writes its own partitions and overwrites them when it is repeated, and a
target's partition is replaced by what the store says: a run that died half way
is simply run again. Ticks whose date does not parse have the NULL month.
Ticks fetched again count again, as in the original job; dedup before (Q9) if
they should not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.exact import STATE, merge_states
from tidemark.operators import rollup as R
from tidemark.schemas import MONTHLY_KEYS, YEARLY_KEYS

STORE = StructType(
    [StructField("Date", DateType()), StructField("ticker", StringType())] + [StructField(s, STATE) for s in R.STATES]
    + [StructField("Year", IntegerType()), StructField("Month", IntegerType()), StructField("batch", LongType())]
)
#: Parts that a batch's ticks of one month are dealt into, by ticker.
SLICES = 32
GRAIN_KEYS = {"monthly": MONTHLY_KEYS, "yearly": YEARLY_KEYS}
GRAIN_PARTITIONS = {"monthly": ["Year", "Month"], "yearly": ["Year"]}


def fold(ticks: DataFrame, store: str, batch: int) -> None:
    """Adds the ticks' daily sum states to the store, as batch number `batch`.

    The ticks are dealt out by slices of months before they are summed up: a month is written
    by one task where batches are small, by `SLICES` at most where they are large, and no state is shuffled.
    """
    states = R.daily_partials(ticks, SLICES).withColumn("batch", F.lit(batch).cast(LongType()))
    (states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("Year", "Month", "batch").parquet(store))


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(store)


def touched(spark: SparkSession, store: str, batch: int, by: list[str]) -> Column:
    """A static filter on the periods that a batch wrote (partition values only: a few, from folder names)."""
    rows = read_store(spark, store).filter(F.col("batch") == batch).select(*by).distinct().collect()
    each = [reduce(lambda a, b: a & b, [F.col(c).isNull() if r[c] is None else F.col(c) == r[c] for c in by]) for r in rows]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)


def averages_of(states: DataFrame, grain: str) -> DataFrame:
    """Monthly or yearly averages of stored states."""
    merged = states.groupBy(*GRAIN_KEYS[grain]).agg(*[merge_states(s).alias(s) for s in R.STATES])
    return R.averages(merged)


def refresh(spark: SparkSession, store: str, batch: int, target: str, grain: str) -> None:
    """Recomputes the target's partitions that the batch touched, from the store's partitions of the same periods."""
    by = GRAIN_PARTITIONS[grain]
    states = read_store(spark, store).filter(touched(spark, store, batch, by))
    (averages_of(states, grain).hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(target))
