"""Sinks and staging.

Single-file output (one task) removes write parallelism, so it is an option,
off by default; order is only imposed where a reader can see it.
"""

from __future__ import annotations

import gzip
import os
import re
import uuid
from collections.abc import Iterator
from itertools import groupby, islice
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from tidemark.session import scratch_path, ship_package


class EmptyInput(RuntimeError):
    """Raised by `guard_empty(..., on_empty="fail")`."""


def guard_empty(df: DataFrame, on_empty: str = "skip") -> bool:
    """True when `df` has rows. `on_empty` is "skip" (return False) or "fail".

    `isEmpty` stops at the first row, so this is cheap even on a large input.
    """
    if not df.isEmpty():
        return True
    if on_empty == "fail":
        raise EmptyInput("input has no rows")
    return False


def counted(df: DataFrame, name: str = "rows"):
    """A5: count rows while a sink writes them, without a second pass.

    Returns `(df_with_observation, observation)`; read
    `observation.get["rows"]` after the action.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_json(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite", compression: str | None = None) -> None:
    """K2 (and K1 without ordering): JSON lines; NULL fields are left out. `compression`: "gzip" for staging folders of many rows."""
    (df.coalesce(1) if single_file else df).write.mode(mode).json(path, compression=compression)


def _once(df: DataFrame) -> DataFrame:
    """`df` stored in the session's checkpoint folder: a range sort runs its input twice, to sample the keys and to deal out the rows."""
    if any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        return df  # Parquet has no such type
    path = scratch_path(df.sparkSession, "unsorted")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json_sorted(df: DataFrame, path: str, by: str = "emiten", single_file: bool = False,
                      count_rows: bool = False) -> int | None:
    """K1: JSON lines in global `by` order.

    The parts are range-partitioned and each part is sorted, so reading parts
    in name order gives the global order; with `single_file=True` (a small
    period slice) one task sorts and writes all.
    With `count_rows`, the written rows are counted by an observation placed
    after the sort (the range sort's sampling pass does not count) and the
    count is returned (A5).
    """
    key = F.col(by).asc_nulls_first()
    out = df.repartition(1).sortWithinPartitions(key) if single_file else _once(df).orderBy(key)
    obs = None
    if count_rows:
        out, obs = counted(out)
    out.write.mode("overwrite").json(path)
    return obs.get["rows"] if obs is not None else None


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, compression: str | None = None) -> None:
    """K3: Parquet, optionally partitioned (e.g. by `tahun`, `triwulan`). `compression`: "zstd" for whole filings, whose facts repeat their keys and texts."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_collection(df: DataFrame, path: str, fmt: str = "parquet", sort_by: str | None = "emiten",
                     mode: str = "overwrite", **options) -> None:
    """K4: a whole target collection, sorted, in any format the session has."""
    out = _once(df).orderBy(F.col(sort_by).asc_nulls_first()) if sort_by else df
    out.write.format(fmt).mode(mode).options(**options).save(path)


DOCUMENT_PARTITIONS = ["tahun", "triwulan", "ticker"]


def write_documents(df: DataFrame, path: str, files_per_document: int = 1) -> None:
    """K5: one folder per (tahun, triwulan, ticker) holding that filing's JSON, in one file.

    The rows are first dealt out by those columns, so a folder is written by one
    task and has one file, however many tasks there are. `files_per_document`
    spreads the rows of each over so many tasks and files, for tickers of very many
    documents. Each task puts its own files in place as it ends (the committer's version 2);
    else the driver would move all folders one by one at the end of the job.

    On a local or mounted file system the tasks write the files themselves (`_write_local`): there
    Hadoop, without its native library, starts a process for each file and folder to set its mode.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in DOCUMENT_PARTITIONS]
    salt = [F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]), F.lit(files_per_document))] * (files_per_document > 1)
    dealt = df.repartition(writers(spark), *keys, *salt)
    if folder := _local_folder(spark, path):
        old = [*df.inputFiles()] if os.path.exists(folder) else []
        if any(f"{_plain(f)}/".startswith(f"{folder}/") for f in old):
            raise ValueError(f"{path} is overwritten while it is read")
        # The writer sees to what is there, and to schemas that it refuses.
        none = spark.createDataFrame([], df.schema).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        none.partitionBy(*DOCUMENT_PARTITIONS).json(path)
        _write_local(dealt, folder)
        return
    dealt.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*DOCUMENT_PARTITIONS).json(path)


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder `path` names in the operating system, or None where another file system holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _plain(uri: str) -> str:
    parts = urlsplit(uri)
    return unquote(parts.path) if parts.scheme else uri


def partition_folder(name: str, value: str | None) -> str:
    """`name=value` as Spark's writer names the folder."""
    return f"{name}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else '__HIVE_DEFAULT_PARTITION__'}"


#: Characters that Java writes as `%XX` in the URI of a file.
_QUOTED = re.compile(r"""[^\x80-\U0010ffff0-9A-Za-z/_.!~*'()$&+,;=:@-]""")
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _write_local(dealt: DataFrame, folder: str) -> None:
    """Dealt rows as JSON files below `folder`, named and filled as Spark's writer does; a file is put in place whole.

    A task holds one file open, as its rows are sorted by folder. A task that runs again replaces its files.
    """
    ship_package(dealt.sparkSession)
    job = uuid.uuid4()
    rest = [F.col(f"`{c}`") for c in dealt.columns if c not in DOCUMENT_PARTITIONS]
    named = dealt.select(*[F.col(c).cast("string").alias(c) for c in DOCUMENT_PARTITIONS], F.to_json(F.struct(*rest)).cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, unfinished = f"part-{task.partitionId():05d}-{job}.c000.json", f".{job}.{task.taskAttemptId()}"
        made: set[str] = set()
        files = 0
        rows = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in [*DOCUMENT_PARTITIONS, "line"]]))
        for key, lines in groupby(rows, key=lambda row: row[:-1]):
            *above, last = [partition_folder(c, v) for c, v in zip(DOCUMENT_PARTITIONS, key)]
            period = "/".join([folder, *above])
            if period not in made:
                os.makedirs(period, exist_ok=True)
                made.add(period)
            at = f"{period}/{last}"
            os.makedirs(at, exist_ok=True)
            with open(f"{at}/{unfinished}", "wb", buffering=1 << 16) as f:
                for *_, line in lines:
                    f.write(line + b"\n")
            os.replace(f"{at}/{unfinished}", f"{at}/{name}")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    named.sortWithinPartitions(*DOCUMENT_PARTITIONS).mapInArrow(run, "files long").write.format("noop").mode("overwrite").save()
    open(f"{folder}/_SUCCESS", "wb").close()


def writers(spark: SparkSession) -> int:
    """Tasks for writes of many small files, whose cost is the files and not the bytes that adaptive execution goes by."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString()


def read_documents(spark: SparkSession, path: str, schema: StructType, file: str | None = None) -> DataFrame:
    """K5 read back; the folder names give the partition columns, with the types `schema` has for them.

    `file` names a column for the file a document was read from. The documents' folders are named by a pattern, so
    that one job lists them, many to a task; from the root, Spark runs a job for each period, with a task for each folder.

    Of more folders than Spark lists in the driver, on a local or mounted file system, the tasks
    list and read the files (`_read_local`): Spark's index holds every file in the driver, and a scan some 32 of them to a task.
    """
    most = int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold"))
    if folder := _local_folder(spark, path):
        folders = (x for period in _periods(folder) for x in _subfolders(period))
        if len([*islice(folders, most + 1)]) > most:
            return _read_local(spark, folder, schema, file)
    reader = spark.read.schema(schema)
    try:
        back = reader.option("basePath", path).json("/".join([path.rstrip("/"), *["*"] * len(DOCUMENT_PARTITIONS)]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        back = spark.read.schema(schema).json(path)  # no document
    return back.select("*", F.col("_metadata.file_path").alias(file)) if file else back


def _subfolders(folder: str) -> list[str]:
    """Folders `name=value` in a folder."""
    with os.scandir(folder) as found:
        return [x.path for x in found if "=" in x.name and not x.name.startswith(".") and x.is_dir()]


def _periods(folder: str) -> list[str]:
    """The folders that hold the documents' own, a few."""
    found = [folder] if os.path.isdir(folder) else []
    for _ in DOCUMENT_PARTITIONS[:-1]:
        found = [x for f in found for x in _subfolders(f)]
    return found


def partition_value(folder: str) -> str | None:
    """The value that `partition_folder` named a folder by."""
    value = folder.rsplit("/", 1)[-1].split("=", 1)[1]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


def _document_files(folder: str) -> Iterator[str]:
    for at, below, names in os.walk(folder):
        below[:] = [x for x in below if not x.startswith(("_", "."))]
        yield from (f"{at}/{x}" for x in names if not x.startswith(("_", ".")))


#: Bytes of documents that a task of `_read_local` hands on at a time.
READ_BYTES = 1 << 20


def _read_local(spark: SparkSession, folder: str, schema: StructType, file: str | None) -> DataFrame:
    """Documents below `folder`: tasks list the periods' folders, others read the files, and Spark parses their lines."""
    ship_package(spark)
    n = writers(spark)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for period in b.column("at").to_pylist():
                yield pa.RecordBatch.from_pydict({"at": pa.array(_subfolders(period), pa.string())})

    out = pa.schema([("_t", pa.string()), ("_q", pa.string()), ("_k", pa.string()), ("_file", pa.string()), ("_line", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), out)], schema=out)

        for at in (x for b in batches for x in b.column("at").to_pylist()):
            values = [partition_value(x) for x in at.rsplit("/", 3)[-3:]]
            for name in _document_files(at):
                uri = f"file:{_QUOTED.sub(lambda m: f'%{ord(m[0]):02X}', name)}"
                with (gzip.open if name.endswith(".gz") else open)(name, "rb") as f:
                    for line in (x for whole in f for x in whole.splitlines() if x.strip()):
                        rows.append((*values, uri, line))
                        size += len(line)
                        if size >= READ_BYTES:
                            yield batch()
                            rows, size = [], 0
        if rows:
            yield batch()

    periods = spark.createDataFrame([(x,) for x in _periods(folder)], "at string")
    folders = periods.repartition(n).mapInArrow(listed, "at string").repartition(n)
    lines = folders.mapInArrow(read, "_t string, _q string, _k string, _file string, _line binary")
    rest = StructType([f for f in schema.fields if f.name not in DOCUMENT_PARTITIONS])
    parsed = lines.withColumn("_d", F.from_json(F.col("_line").cast("string"), rest))
    kinds = {f.name: f.dataType for f in schema.fields}
    keys = [F.col(c).cast(kinds.get(name, "string")).alias(name) for c, name in zip(("_t", "_q", "_k"), DOCUMENT_PARTITIONS)]
    return parsed.select(*[F.col(f"_d.`{f.name}`") for f in rest.fields], *keys, *([F.col("_file").alias(file)] if file else []))


def append(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """K6 / K7: batch append; the writer batches, a failed task is retried whole."""
    df.write.format(fmt).mode("append").options(**options).save(path)
