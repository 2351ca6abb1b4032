"""Price tick sources.

`frame_to_ticks` turns a downloaded pricing frame (cells as text or numbers,
one row per trading day) into tick rows with one columnar `select`: the safe
conversions are Column expressions, so there is no per-row Python loop.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from tidemark.functions import exprs as X
from tidemark.functions.periods import iso_to_date, month_of, year_of
from tidemark.schemas import TICK

REQUIRED = ["Open", "High", "Low", "Close", "Volume"]
OPTIONAL = ["Dividends", "Stock Splits"]


def read_ticks(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Ticks from a store, always with the explicit TICK schema."""
    return spark.read.format(fmt).schema(TICK).options(**options).load(path)


#: Ticks as the partitioned store has them: the TICK fields, the day as a date, and its year and month as partitions.
TICK_STORE = StructType([*TICK.fields, StructField("day", DateType()), StructField("tick_year", IntegerType()), StructField("tick_month", IntegerType())])


def append_ticks(ticks: DataFrame, path: str) -> None:
    """K7 into a store that prunes by date: Parquet by year and month, sorted by day inside.

    A range of days reads the folders of its months and, by the files' statistics,
    the row groups of its days. Ticks whose date does not parse go to the NULL month.
    """
    day = iso_to_date(F.col("Date"))
    dated = ticks.withColumn("day", day).withColumn("tick_year", year_of("day")).withColumn("tick_month", month_of("day"))
    dated = dated.select(*[F.col(f"`{f.name}`") for f in TICK_STORE.fields])
    (dated.hint("rebalance", "tick_year", "tick_month").sortWithinPartitions("tick_year", "tick_month", "day")
     .write.mode("append").partitionBy("tick_year", "tick_month").parquet(path))


def read_tick_store(spark: SparkSession, path: str) -> DataFrame:
    """S6 from the partitioned store."""
    return spark.read.schema(TICK_STORE).parquet(path)


def month_to_date_ticks(spark: SparkSession, path: str, as_of: _dt.date) -> DataFrame:
    """D5 over the store: the ticks from the first of `as_of`'s month up to, not including, `as_of`."""
    t = read_tick_store(spark, path)
    month = (F.col("tick_year") == as_of.year) & (F.col("tick_month") == as_of.month)
    return t.filter(month & (F.col("day") >= F.lit(as_of.replace(day=1))) & (F.col("day") < F.lit(as_of)))


def frame_to_ticks(frame: DataFrame, with_ids: bool = True, index: str = "index") -> DataFrame:
    """S11 with P8-P10 and P13.

    `frame` has the trading day in `index` (timestamp or ISO text), the five
    required price/volume columns, optionally `Dividends` and `Stock Splits`
    (absent columns default to 0.0) and `ticker`. With `with_ids`, a random
    24-hex `_id` and the fetch time are added, as the extract does; leave it
    off where results must be reproducible.
    """
    missing = [c for c in REQUIRED + ["ticker", index] if c not in frame.columns]
    if missing:
        raise ValueError(f"pricing frame lacks {missing}")
    idx = F.col(f"`{index}`")
    if isinstance(frame.schema[index].dataType, (TimestampType, TimestampNTZType)):
        idx = F.date_format(idx, "yyyy-MM-dd'T'HH:mm:ss")
    cols = []
    if with_ids:
        cols.append(X.surrogate_id().alias("_id"))
    cols += [
        idx.cast(StringType()).alias("Date"),
        X.safe_float("Open").alias("Open"),
        X.safe_float("High").alias("High"),
        X.safe_float("Low").alias("Low"),
        X.safe_float("Close").alias("Close"),
        X.safe_int("Volume").alias("Volume"),
    ]
    for c in OPTIONAL:
        src = F.col(f"`{c}`") if c in frame.columns else F.lit(None).cast(StringType())
        cols.append(X.safe_float(src).alias(c))
    cols.append(F.col("ticker").cast(StringType()).alias("ticker"))
    if with_ids:
        cols.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetch_timestamp"))
    return frame.select(*cols)
