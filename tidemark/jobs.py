"""The scheduled steps of the original ETL, composed from the operators.

Each step takes paths (any Hadoop file system) instead of database URIs, reads
with explicit schemas, and returns small summaries (row counts, merge outcomes)
counted while the data are written, never the data.

Stores of filings and sector rows are partitioned by (`tahun`, `triwulan`),
those of monthly and yearly averages by `Year`. A load stores its batch once,
reads the target's partitions that the batch touches and no others, merges, and
overwrites just those partitions. The daily store is appended to. What the steps
store in between lies in the session's checkpoint folder, which is the session's to clean.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tidemark.functions.exprs import canonical_order
from tidemark.functions.periods import latest_closed_period_of
from tidemark.operators import merge as M
from tidemark.operators import partials as PT
from tidemark.operators import rollup as R
from tidemark.operators import sectors as S
from tidemark.schemas import (
    AVG_COLUMNS,
    DAILY_AGG,
    FILING_KEYS,
    MONTHLY_AGG,
    MONTHLY_KEYS,
    SECTOR_COLUMNS,
    SECTOR_KEYS,
    SECTOR_ROW,
    YEARLY_AGG,
    YEARLY_KEYS,
)
from tidemark.session import scratch_path
from tidemark.sinks import writers as W
from tidemark.sources import staged as ST
from tidemark.sources import xbrl as XB
from tidemark.sources.ticks import append_ticks, frame_to_ticks, read_ticks

PERIOD = ["tahun", "triwulan"]
STAMP = "load_timestamp"


def period_filter(as_of: date | None) -> Column:
    """Rows of the latest closed period of a day; all rows without one."""
    if as_of is None:
        return F.lit(True)
    year, quarter = latest_closed_period_of(as_of)
    return (F.col("tahun") == str(year)) & (F.col("triwulan") == f"TW{quarter}")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _touched(batch: DataFrame, by: list[str]) -> Column:
    """A static filter on the partitions of the batch (a few periods, not rows)."""
    groups = batch.select(*by).distinct().collect()
    out = F.lit(False)
    for g in groups:
        one = F.lit(True)
        for c in by:
            one = one & F.col(c).eqNullSafe(F.lit(g[c]))
        out = out | one
    return out


def merge_into(batch: DataFrame, target_path: str, schema: StructType, keys: list[str], by: list[str], mode: str,
               null_safe: bool = False, ignore: tuple[str, ...] = (), seq: str | None = None) -> dict:
    """Merge a stored batch into a partitioned Parquet target; returns outcomes per key of the partitions touched.

    The batch is folded in the order of `seq`. The merge reads the partitions that
    the batch touches, and replaces them when all of it is done, so it writes
    straight to them. A key that the target holds twice makes the load fail before that
    (`DuplicateKeys`), with the target as it was.
    """
    spark = batch.sparkSession
    if ST.exists(spark, target_path):
        target = spark.read.schema(schema).parquet(target_path).filter(_touched(batch, by))
    else:
        target = spark.createDataFrame([], schema)
    seen = Observation()
    merged = M.merge(target, batch, keys, mode, seq, null_safe, ignore, check_target=True)
    actions = ["inserted", "updated", "unchanged", "untouched"]
    merged = merged.observe(seen, *[F.count(F.when(F.col(M.ACTION) == a, 1)).alias(a) for a in actions]).drop(M.ACTION)
    ready = canonical_order(merged, schema.fieldNames())
    try:
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target_path)
    except Exception as e:
        if M.REFUSAL in str(e):
            raise M.DuplicateKeys(str(e)[str(e).index(M.REFUSAL):].splitlines()[0]) from e
        raise
    return {a: n for a, n in seen.get.items() if n}


def ingest_filings(spark: SparkSession, archives_path: str, filings_path: str, status_path: str | None = None, as_of: date | None = None, pattern: str = "*.zip") -> dict:
    """Archives `<tahun>/<triwulan>/<ticker>/*.zip` (or `tahun=<tahun>/...`) -> facts -> documents in the promoted layout -> replace-upsert.

    Every archive gets a status; those without a readable instance are kept
    from the store and told apart in the returned counts (and in
    `status_path`). A period limits the files that are read at all.
    """
    path = archives_path.rstrip("/")
    if as_of is not None:
        year, quarter = latest_closed_period_of(as_of)
        bare = f"{path}/{year}/TW{quarter}"
        path = bare if ST.exists(spark, bare) else f"{path}/tahun={year}/triwulan=TW{quarter}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    parts = F.split(F.col("path"), "/")
    # Folders may be bare values or `name=value`, as a partitioned writer leaves them.
    value = lambda at: F.regexp_replace(F.element_at(parts, at), "^[a-z]+=", "")
    named = files.select(value(-2).alias("ticker"), value(-4).alias("tahun"), value(-3).alias("triwulan"), F.col("path").alias(ST.ORDER), "content")
    return ingest_archives(named, filings_path, status_path, ST.ORDER)


def ingest_archives(named: DataFrame, filings_path: str, status_path: str | None = None, seq: str | None = None) -> dict:
    """The same for archives in hand: ticker, tahun, triwulan, content.

    The whole document is stored, its facts and file info beside the promoted
    columns. When it was processed does not make a document another one. Of several
    archives of one key the last in the order of `seq` (the path, for files) counts.
    Instances are parsed as they are unpacked, in bounded memory.
    """
    parsed = _staged(XB.archive_facts(named), "parsed")
    status = parsed.filter("last").select(*FILING_KEYS, "status", "error")
    if status_path:
        status.write.mode("append").parquet(status_path)
    order = [seq] * (seq is not None)
    documents = XB.filing_documents(XB.whole_facts(parsed).withColumn("quarter", F.expr("substring(triwulan, 3)")), quarter="quarter", keep=order)
    promoted = _staged(S.promote_rule_facts(documents), "documents")
    schema = StructType([f for f in promoted.schema.fields if f.name != seq])
    out = merge_into(promoted, filings_path, schema, FILING_KEYS, PERIOD, "replace", ignore=("processed_date",), seq=seq)
    return {**out, **{f"status_{r['status']}": r["count"] for r in status.groupBy("status").count().collect()}}


def ingest_prices(spark: SparkSession, frame: DataFrame, ticks_path: str, partitioned: bool = False) -> dict:
    """A downloaded pricing frame -> ticks with ids -> appended (S11, P13, K7); `partitioned`: to a store by month."""
    ticks, seen = W.counted(frame_to_ticks(frame))
    if partitioned:
        append_ticks(ticks, ticks_path)
    else:
        W.append(ticks, ticks_path, fmt="json")
    return {"appended": seen.get["rows"]}


def transform_filings(spark: SparkSession, filings_path: str, out_path: str, fmt: str = "json",
                      single_file: bool = False, on_empty: str = "skip", as_of: date | None = None) -> dict:
    """Filing documents (of one period) -> sector rows, sorted by `emiten`, staged as JSON lines.

    Filings already in the promoted layout (`rule_facts`, `fmt="parquet"`)
    are read without the map. The rules run once, over the period's filings;
    rows and filings dropped for a NULL sector are counted as they are written.
    """
    filings = spark.read.parquet(filings_path) if fmt == "parquet" else ST.read_filings(spark, filings_path, fmt)
    filings = filings.filter(period_filter(as_of))
    if not W.guard_empty(filings, on_empty):
        return {"rows": 0, "null_sector": 0}
    seen = Observation()
    null_sector = F.col("sector").isNull() if "sector" in filings.columns else S.fact(S.SECTOR_KEY).isNull()
    rows, written = W.counted(S.sector_rows(filings.observe(seen, F.count(F.when(null_sector, 1)).alias("null_sector"))))
    W.write_json_sorted(rows, out_path, by="emiten", single_file=single_file)
    return {"rows": written.get["rows"], "null_sector": seen.get["null_sector"]}


def load_sector_rows(spark: SparkSession, staged_path: str, target_path: str, as_of: date | None = None) -> dict:
    """Staged sector rows -> `$set` upsert into the target, partitioned by period.

    Records without `emiten`, `tahun` or `triwulan` are skipped (F8); several
    records of a key are folded in the order of file names, then of lines; fields are
    written in the standard order (P14). Returns merge outcome counts.
    """
    incoming = M.required_keys(ST.read_staged_json(spark, staged_path, SECTOR_ROW, strict=True, ordered=True), SECTOR_KEYS)
    batch = _staged(incoming.filter(period_filter(as_of)), "batch")
    return merge_into(batch, target_path, SECTOR_ROW, SECTOR_KEYS, PERIOD, "set", seq=ST.ORDER)


def load_single_job(spark: SparkSession, staged_parquet: str, collection_path: str) -> dict:
    """The older single-job load: the Parquet hand-off, sorted, overwrites the collection."""
    rows = ST.read_staged_parquet(spark, staged_parquet)
    if rows is None or not W.guard_empty(rows):
        return {"rows": 0}
    rows, seen = W.counted(canonical_order(rows, SECTOR_COLUMNS))
    W.write_collection(rows, collection_path)
    return {"rows": seen.get["rows"]}


def transform_prices(spark: SparkSession, ticks_path: str, out_base: str, fmt: str = "json",
                     on_empty: str = "fail", latest_fetch: bool = False) -> dict:
    """Ticks -> daily, monthly and yearly averages, staged as JSON folders.

    One scan of the ticks (grouping sets over daily partials); the small
    aggregated result is cached for the three writes and released after.
    """
    ticks = read_ticks(spark, ticks_path, fmt)
    if not W.guard_empty(ticks, on_empty):
        return {}
    if latest_fetch:  # Q9: one tick per day and ticker
        ticks = R.latest_fetch_only(ticks)
    grains = R.all_grains(ticks).persist()
    try:
        daily = grains.filter(F.col("grain") == "daily").select(
            F.date_format("Date", "yyyy-MM-dd").alias("Date"), "ticker", *AVG_COLUMNS)
        monthly = grains.filter(F.col("grain") == "monthly").select(*MONTHLY_KEYS, *AVG_COLUMNS)
        yearly = grains.filter(F.col("grain") == "yearly").select(*YEARLY_KEYS, *AVG_COLUMNS)
        base = out_base.rstrip("/")
        W.write_json(daily, f"{base}/daily_aggregation")
        W.write_json(monthly, f"{base}/monthly_aggregation")
        W.write_json(yearly, f"{base}/yearly_aggregation")
        counts = {r.grain: r["count"] for r in grains.groupBy("grain").count().collect()}
    finally:
        grains.unpersist()
    return counts


def load_prices(spark: SparkSession, staged_base: str, targets: dict[str, str], upsert_daily: bool = False, rejects_path: str | None = None, files: str = ST.PART_FILES) -> dict:
    """Staged aggregates -> targets: daily appended, monthly / yearly replace-upserted.

    `targets` maps 'daily' / 'monthly' / 'yearly' to the target path. Only
    loaded rows get the load time; stored rows keep theirs. Each folder is read
    and parsed once: lines that are not JSON records are counted, and kept aside in
    `rejects_path` with their file, place and reason. Appended rows go straight to the target;
    only where rejects among them are to be kept aside is their folder read again. `upsert_daily` (Q10) replaces daily
    rows by key instead of appending. Monthly and yearly keys match NULL to NULL;
    several records of a key are folded in the order of file names, then of lines.
    """
    base = staged_base.rstrip("/")
    kinds = {"daily": (DAILY_AGG, ["Date", "ticker"]), "monthly": (MONTHLY_AGG, MONTHLY_KEYS), "yearly": (YEARLY_AGG, YEARLY_KEYS)}
    out: dict[str, dict] = {}
    for kind, (schema, keys) in kinds.items():
        folder = f"{base}/{kind}_aggregation"
        if not ST.exists(spark, folder):
            continue
        seen, appended = Observation(), kind == "daily" and not upsert_daily
        parsed = ST.parse_lenient(spark, folder, schema, files).observe(seen, *ST.lenient_counts()).withColumn(STAMP, F.current_timestamp())
        stored = StructType([*schema.fields, StructField("aggregation_type", StringType()), StructField(STAMP, TimestampType())])
        label = F.lit(f"{kind}_aggregation")
        if appended:
            W.append(ST.accepted(parsed).withColumn("aggregation_type", label).select(*stored.fieldNames()), targets[kind])
            parsed = ST.parse_lenient(spark, folder, schema, files)
        else:
            parsed = _staged(parsed, "parsed")
        counts = seen.get
        if rejects_path and counts["malformed"]:
            ST.rejects(parsed).withColumn("aggregation_type", label).write.mode("append").parquet(rejects_path)
        incoming = ST.accepted(parsed, ordered=True).withColumn("aggregation_type", label)
        if appended:
            out[kind] = {"appended": counts["good"]}
        elif kind == "daily":
            incoming = incoming.withColumn("Year", F.substring("Date", 1, 4))
            out[kind] = merge_into(incoming, targets[kind], StructType([*stored.fields, StructField("Year", StringType())]), keys, ["Year"], "replace", True, (STAMP,), ST.ORDER)
        else:
            out[kind] = merge_into(incoming, targets[kind], stored, keys, ["Year"], "replace", True, (STAMP,), ST.ORDER)
        out[kind] |= {"rejected": counts["malformed"]} | ({"mistyped": counts["mistyped"]} if counts["mistyped"] else {})
    return out


def refresh_prices(spark: SparkSession, ticks: DataFrame, store: str, targets: dict[str, str], batch: int) -> None:
    """New ticks -> the store of daily sums -> the monthly and yearly averages they touch (`operators.partials`)."""
    PT.fold(ticks, store, batch)
    for grain in ("monthly", "yearly"):
        if grain in targets:
            PT.refresh(spark, store, batch, targets[grain], grain)
