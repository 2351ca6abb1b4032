"""Tables bucketed by their keys, for merges that do not shuffle the target (M1, M2).

A merge joins the target with a batch on the keys. A plain Parquet folder is
shuffled for that, however small the batch; a table written in buckets of the keys
is already dealt out, so only the batch moves. The files carry their bucket in
their names, and the definition is a statement of the session's catalog over a path, so
any session can open them.

A merged table is written as a new one: Spark does not overwrite a table it reads.
For stores of which a batch touches few periods, partitions by period
(`jobs.merge_into`) are the better layout; for those of which it touches
most, this one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_name(path: str) -> str:
    """The catalog's name for a path."""
    return "tidemark_keyed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()[:16]


def write_keyed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """A new bucketed table at `path`, one file a bucket. Rows that a merge has dealt out by the keys stay where they are."""
    name = table_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *[f"`{k}`" for k in keys]).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name))


def read_keyed(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
    """The bucketed table at `path`, as `write_keyed` left it, in this session or another."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
