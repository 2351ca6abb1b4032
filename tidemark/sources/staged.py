"""File sources: ticker lists, staged JSON and Parquet, filing documents.

Every reader passes an explicit schema. A missing or empty input folder is
reported by `exists` / `guard_empty` rather than by a failing job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.exprs import is_blank, strip, with_load_metadata
from tidemark.schemas import FILING

# The three staged aggregate folders.
AGGREGATE_FOLDERS = ["daily_aggregation", "monthly_aggregation", "yearly_aggregation"]
_NUL = "\u0000"
#: The files of a staging folder, as they are or compressed.
PART_FILES = "part-*.json{,.gz}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists, through the cluster's file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_ticker_csv(spark: SparkSession, path: str) -> DataFrame:
    """One-column CSV with a header; first column, trimmed, blanks dropped.

    The header line of every file is skipped (a BOM sits in that line);
    empty lines are skipped by the reader and blank-only values by the
    filter (F9). Extra columns on a line are ignored.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").schema("emiten string").csv(path)
    return df.select(strip("emiten").alias("ticker")).filter(~is_blank("ticker"))


def read_ticker_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain lines, first line of each file skipped, whole line stripped.

    The CSV reader with a delimiter that cannot occur reads whole lines
    (commas included) and still skips each file's first line.
    """
    df = (spark.read.option("header", True).option("sep", _NUL).option("quote", _NUL)
          .schema("line string").csv(path))
    return df.select(strip("line").alias("ticker")).filter(~is_blank("ticker"))


def read_filings(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Filing documents with the explicit FILING schema (facts as a map)."""
    return spark.read.format(fmt).schema(FILING).options(**options).load(path)


#: The place of a record in its folder; a struct that orders by file name, then by line.
ORDER = "_order"
#: Why a line is no record (NULL if it is one), whether a value has another type, and the line itself where it is rejected.
REASON, MISTYPED, LINE = "_reason", "_mistyped", "_line"


def reading_order() -> Column:
    """File, start of the split in it, number of the row: rows of a split are read, and so numbered, in order.

    Spark deals files to tasks by size, so the order in which it reads says nothing
    about the order of files; their names do.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def parse_lenient(spark: SparkSession, path: str, schema: StructType, files: str = PART_FILES) -> DataFrame:
    """S8 in one scan: the schema's fields of every line, with its place (`_order`), `_reason`, `_mistyped` and `_line`.

    A line that is not a JSON record is rejected, with its reason and text; its
    fields are NULL. A value of another type than the schema's is a record all
    the same, with that field NULL (`_mistyped`), whichever columns are selected later.
    Records are parsed once; only lines that this parse finds fault with
    are looked at again.
    """
    lines = spark.read.option("pathGlobFilter", files).text(path).select("value", reading_order().alias(ORDER)).filter(F.col("value") != "")
    with_fault = StructType([*schema.fields, StructField("_corrupt", StringType())])
    read = lines.withColumn("r", F.from_json("value", with_fault, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    plain = F.col("r._corrupt").isNull() & F.col("r").isNotNull() & F.ltrim("value").startswith("{") & F.rtrim("value").endswith("}")
    judged = read.withColumn("plain", F.coalesce(plain, F.lit(False)))
    judged = judged.withColumn("json", F.when(~F.col("plain"), F.expr("try_parse_json(value)")))
    judged = judged.withColumn("good", F.col("plain") | (F.col("json").isNotNull() & F.expr("schema_of_variant(json)").startswith("OBJECT") & F.rtrim("value").endswith("}")))

    def get(name: str, kind: str) -> Column:
        return F.expr(f"try_variant_get(json, '$[\"{name}\"]', '{kind}')")

    fields, mistyped = [], F.lit(False)
    for f in schema.fields:
        again = get(f.name, f.dataType.simpleString())
        fields.append(F.when(F.col("plain"), F.col(f"r.`{f.name}`")).when(F.col("good"), again).alias(f.name))
        mistyped = mistyped | (get(f.name, "string").isNotNull() & again.isNull())
    other = F.col("json").isNotNull() & ~F.expr("schema_of_variant(json)").startswith("OBJECT")
    reason = F.when(~F.coalesce("good", F.lit(False)), F.when(other, F.lit("not an object")).otherwise(F.lit("not JSON")))
    return judged.select(*fields, ORDER, reason.alias(REASON), (F.coalesce("good", F.lit(False)) & ~F.col("plain") & mistyped).alias(MISTYPED), F.when(reason.isNotNull(), F.col("value")).alias(LINE))


def lenient_counts() -> list[Column]:
    """What a lenient read saw, as aggregates: `malformed`, `good` and `mistyped` lines."""
    return [F.count(F.when(F.col(REASON).isNotNull(), 1)).alias("malformed"), F.count(F.when(F.col(REASON).isNull(), 1)).alias("good"), F.count(F.when(F.col(MISTYPED), 1)).alias("mistyped")]


def rejects(parsed: DataFrame) -> DataFrame:
    """The rejected lines of `parse_lenient`: file name, place in it, reason and text."""
    name = F.element_at(F.split(F.col(ORDER)["file"], "/"), -1)
    return parsed.filter(F.col(REASON).isNotNull()).select(name.alias("file"), F.col(ORDER)["block"].alias("block"), F.col(ORDER)["row"].alias("row"), F.col(REASON).alias("reason"), F.col(LINE).alias("line"))


def accepted(parsed: DataFrame, ordered: bool = False) -> DataFrame:
    """The records of `parse_lenient`, with their place if `ordered`."""
    return parsed.filter(F.col(REASON).isNull()).drop(REASON, MISTYPED, LINE, *[ORDER] * (not ordered))


def read_staged_json(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True, files: str = PART_FILES, ordered: bool = False) -> DataFrame:
    """S7 (strict) / S8 (lenient): the `part-*.json` files (or `.json.gz`) of a staging folder.

    Strict: a malformed line fails the read (no half-read file is kept).
    Lenient: lines that are not JSON records are dropped (`parse_lenient` has
    them), all others kept, also where a value has another type than
    the schema's: that field is NULL then. `ordered` adds the place of each record (`_order`).
    """
    if strict:
        df = spark.read.schema(schema).option("pathGlobFilter", files).option("mode", "FAILFAST").json(path)
        return df.select("*", reading_order().alias(ORDER)) if ordered else df
    s = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return accepted(parse_lenient(spark, path, s, files), ordered)


def count_malformed(spark: SparkSession, path: str, schema: StructType, files: str = PART_FILES) -> DataFrame:
    """S8 counts of a folder that is not loaded; a load observes `lenient_counts` in its own scan."""
    return parse_lenient(spark, path, schema, files).agg(*lenient_counts())


def read_aggregate_folders(spark: SparkSession, base: str, schemas: dict[str, StructType],
                           strict: bool = False) -> DataFrame | None:
    """S9 + P12: read the staged aggregate folders that exist, tag each row.

    A missing folder is skipped. Rows get `aggregation_type` and
    `load_timestamp`; columns missing in one kind are NULL (union by name).
    """
    out = None
    for kind in AGGREGATE_FOLDERS:
        p = f"{base.rstrip('/')}/{kind}"
        if kind not in schemas or not exists(spark, p):
            continue
        df = with_load_metadata(read_staged_json(spark, p, schemas[kind], strict), kind)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_staged_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A staged Parquet folder, or None when it is missing.

    With a schema, partition columns keep their declared types (a `tahun`
    folder value stays text instead of being inferred as a number).
    """
    if not exists(spark, path):
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)
