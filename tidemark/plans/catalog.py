"""Registered queries: one per operator of the inventory.

Each entry takes `(spark, sf_dir)` and returns a lazy DataFrame built from
the driver's tables through `tidemark.plans.views`. Results are presented
the way the JSON staging sink writes them (dates as ISO text, money as
double), so they compare one to one with the DuckDB restatements in
`tidemark.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, TimestampNTZType, TimestampType

from tidemark.functions import exprs as X
from tidemark.functions import periods as PD
from tidemark.operators import rollup as R
from tidemark.operators import sectors as S
from tidemark.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Dates -> 'yyyy-MM-dd', timestamps -> ISO text, decimals -> double."""
    cols = []
    for fld in df.schema.fields:
        c = F.col(f"`{fld.name}`")
        if isinstance(fld.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(fld.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(fld.dataType, DecimalType):
            c = c.cast(DoubleType())
        cols.append(c.alias(fld.name))
    return df.select(*cols)


# ---------------------------------------------------------------- roll-up


def avg_daily(spark, sf):
    return present(R.daily_average(V.ticks(spark, sf)))


def avg_monthly(spark, sf):
    return present(R.monthly_average(V.ticks(spark, sf)))


def avg_yearly(spark, sf):
    return present(R.yearly_average(V.ticks(spark, sf)))


def avg_grouping_sets(spark, sf):
    return present(R.all_grains(V.ticks(spark, sf)))


def avg_daily_latest_fetch(spark, sf):
    return present(R.daily_average(R.latest_fetch_only(V.ticks(spark, sf))))


MONTH_TO_DATE_AS_OF = "1998-08-20"


def month_to_date_ticks(spark, sf):
    t = R.with_periods(V.ticks(spark, sf))
    return present(
        t.filter(PD.month_to_date(F.col("Date"), F.lit(MONTH_TO_DATE_AS_OF)))
        .select("_id", "Date", "ticker", "Close")
    )


# ---------------------------------------------------------------- scalars


def reporting_period(spark, sf):
    d = V.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
    y, q = PD.latest_closed_period(F.col("as_of"))
    return present(d.select("as_of", y.alias("period_year"), q.alias("period_quarter")))


def iso_to_date(spark, sf):
    ev = V.table(spark, sf, "events")
    txt = (
        F.when(F.col("event_type") == "error", F.lit("not a date"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    d = PD.iso_to_date(txt)
    return present(ev.select("event_id", d.alias("parsed"), PD.year_of(d).alias("Year"),
                             PD.month_of(d).alias("Month")))


def safe_float(spark, sf):
    r = V.raw_ticks(spark, sf)
    return r.select("l_orderkey", "l_linenumber", X.safe_float("Open").alias("Open"),
                    X.safe_float("Dividends").alias("Dividends"))


def safe_int(spark, sf):
    r = V.raw_ticks(spark, sf)
    return r.select("l_orderkey", "l_linenumber", X.safe_int("Volume").alias("Volume"))


def price_frame_rows(spark, sf):
    from tidemark.sources.ticks import frame_to_ticks

    r = V.raw_ticks(spark, sf)  # has no "Stock Splits" column: P10 default
    t = frame_to_ticks(r, with_ids=False)
    return t.select(F.concat("ticker", F.lit(".JK")).alias("symbol"), "ticker", "Date", "Open", "High", "Low",
                    "Close", "Volume", "Dividends", "Stock Splits")


def fetch_manifest(spark, sf):
    from tidemark.sources.manifest import filing_manifest

    keys = V.filing_fact_columns(spark, sf).select("ticker", "tahun", "triwulan")
    return filing_manifest(keys, base_url=MANIFEST_BASE)


MANIFEST_BASE = "https://example.invalid/reports"


def _filing_measure(build):
    def q(spark, sf):
        fl = V.filings(spark, sf)
        return present(fl.select("ticker", "tahun", "triwulan", build().alias("value")))

    return q


sum_if_any = _filing_measure(lambda: X.sum_if_any(
    S.fact(f"BorrowingsRelatedParties_{S.I}"), S.fact(f"BondsPayable_{S.I}"), S.fact(f"Sukuk_{S.I}")))
guarded_difference = _filing_measure(lambda: X.guarded_difference(
    S.fact(f"BankLoans_{S.P}"), S.fact(f"BankLoans_{S.I}")))
sum_minus_required = _filing_measure(lambda: S.build(S.RULES["gross_profit"][S.INVESTMENT]))
required_minus_optional = _filing_measure(lambda: S.build(S.RULES["gross_profit"][S.INSURANCE]))
first_present = _filing_measure(lambda: S.build(S.RULES["short_term_borrowing"][S.OTHER]))


# ---------------------------------------------------------------- sectors


def _branch(sector):
    def q(spark, sf):
        return present(S.sector_branch(V.filings(spark, sf), sector))

    return q


sector_banks = _branch(S.BANKS)
sector_financing = _branch(S.FINANCING)
sector_investment = _branch(S.INVESTMENT)
sector_insurance = _branch(S.INSURANCE)
sector_other = _branch(S.OTHER)


def sector_union(spark, sf):
    return present(S.sector_rows_union(V.filings(spark, sf)))


def sector_one_pass(spark, sf):
    return present(S.sector_rows(V.filings(spark, sf)))


def sector_one_pass_promoted(spark, sf):
    """The rules on the ingest layout (promoted `sector` and `rule_facts`)."""
    return present(S.sector_rows(S.promote_rule_facts(V.filings(spark, sf)).drop("facts")))


def sector_rows_without_period(spark, sf):
    """The older single-job variant: the same rules without `tahun` / `triwulan`."""
    return present(S.sector_rows(V.filings(spark, sf), with_period=False))


def sector_null_dropped(spark, sf):
    return S.dropped_null_sector(V.filings(spark, sf)).select("ticker", "tahun", "triwulan")


def registry() -> dict[str, Query]:
    names = [
        "avg_daily", "avg_monthly", "avg_yearly", "avg_grouping_sets", "avg_daily_latest_fetch",
        "month_to_date_ticks",
        "reporting_period", "iso_to_date", "safe_float", "safe_int", "price_frame_rows", "fetch_manifest",
        "sum_if_any", "guarded_difference", "sum_minus_required", "required_minus_optional", "first_present",
        "sector_banks", "sector_financing", "sector_investment", "sector_insurance", "sector_other",
        "sector_union", "sector_one_pass", "sector_one_pass_promoted", "sector_rows_without_period",
        "sector_null_dropped",
    ] + MERGE_QUERIES + INGEST_QUERIES + STREAM_QUERIES + JOB_QUERIES
    g = globals()
    return {n: g[n] for n in names}


# ---------------------------------------------------------------- merge
# Overlapping batches: the target holds everything before a cut, the
# incoming batch everything after an earlier cut with some values revised, so
# the overlap changes, the tail is new and the head is untouched. Every order
# and line item is in one batch at least.

OLD_ORDERS = "o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'"
NEW_ORDERS = "o_orderdate >= TIMESTAMP_NTZ'1997-07-01 00:00:00'"
OLD_TICKS = "l_shipdate < TIMESTAMP_NTZ'1999-07-01 00:00:00'"
NEW_TICKS = "l_shipdate >= TIMESTAMP_NTZ'1999-01-01 00:00:00'"
ALL_NEW_TICKS = NEW_TICKS


def _filing_summary(fl: DataFrame) -> DataFrame:
    return fl.select(
        "ticker", "tahun", "triwulan",
        F.size("facts").cast("int").alias("n_facts"),
        S.fact(S.SECTOR_KEY).alias("sector"),
        S.fact(f"SalesAndRevenue_{S.D}").alias("sales_text"),
        S.fact(f"Assets_{S.I}").alias("assets_text"),
    )


def replace_upsert_filings(spark, sf):
    from tidemark.operators import merge as M

    old = V.filings(spark, sf, F.expr(OLD_ORDERS))
    new = V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True)
    return _filing_summary(M.replace_upsert(old, new, ["ticker", "tahun", "triwulan"]))


def set_upsert_rows(spark, sf):
    from tidemark.operators import merge as M

    old = S.sector_rows(V.filings(spark, sf, F.expr(OLD_ORDERS)))
    new = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True))
    return present(M.set_upsert(old, new, ["emiten", "tahun", "triwulan"]))


def bucketed_upsert_rows(spark, sf):
    """M2 over a target bucketed by its keys, which the merge does not shuffle; the result as a bucketed table again."""
    from tidemark.operators import merge as M
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sources.keyed import read_keyed, write_keyed

    old, merged = scratch_path(spark, "keyed"), scratch_path(spark, "keyed-merged")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_keyed(S.sector_rows(V.filings(spark, sf, F.expr(OLD_ORDERS))), old, SECTOR_KEYS, n)
    new = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True))
    write_keyed(M.set_upsert(read_keyed(spark, old, SECTOR_ROW, SECTOR_KEYS, n), new, SECTOR_KEYS), merged, SECTOR_KEYS, n)
    return present(read_keyed(spark, merged, SECTOR_ROW, SECTOR_KEYS, n))


def _monthly_pair(spark, sf):
    old = R.monthly_average(V.ticks(spark, sf, F.expr(OLD_TICKS)))
    new = R.monthly_average(V.revised_ticks(spark, sf, F.expr(NEW_TICKS)))
    return old, new


def replace_upsert_monthly(spark, sf):
    from tidemark.operators import merge as M

    old, new = _monthly_pair(spark, sf)
    return present(M.replace_upsert(old, new, ["Year", "Month", "ticker"], null_safe=True))


def replace_upsert_yearly(spark, sf):
    from tidemark.operators import merge as M

    old = R.yearly_average(V.ticks(spark, sf, F.expr(OLD_TICKS)))
    new = R.yearly_average(V.revised_ticks(spark, sf, F.expr(NEW_TICKS)))
    return present(M.replace_upsert(old, new, ["Year", "ticker"], null_safe=True))


def merge_outcomes(spark, sf):
    from tidemark.operators import merge as M

    old, new = _monthly_pair(spark, sf)
    return M.merge_outcomes(old, new, ["Year", "Month", "ticker"], mode="replace", null_safe=True)


def last_write_wins(spark, sf):
    from tidemark.operators import merge as M

    b = V.ticks_with_seq(spark, sf).select("Date", "ticker", "seq", "Open", "Close")
    return M.last_write_wins(b, ["Date", "ticker"], "seq", keep_seq=True)


def set_fold_batch(spark, sf):
    from tidemark.operators import merge as M

    b = V.ticks_with_seq(spark, sf).select(
        "Date", "ticker", "seq", "Open",
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("Close")).alias("Close"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("Dividends")).alias("Dividends"),
    )
    return M.set_fold(b, ["Date", "ticker"], "seq")


def _daily_appended(spark, sf):
    from tidemark.operators import merge as M

    old = R.daily_average(V.ticks(spark, sf, F.expr(OLD_TICKS)))
    new = R.daily_average(V.ticks(spark, sf, F.expr(ALL_NEW_TICKS)))
    return M.append(old, new)


def append_daily(spark, sf):
    return present(_daily_appended(spark, sf))


def duplicate_keys(spark, sf):
    from tidemark.operators import merge as M

    return present(M.duplicate_keys(_daily_appended(spark, sf), ["Date", "ticker"]))


def required_keys(spark, sf):
    from tidemark.operators import merge as M

    t = V.ticks_with_seq(spark, sf)
    t = t.withColumn("Date", F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("Date")))
    monthly = R.monthly_average(t.drop("seq", "l_returnflag", "l_linenumber"))
    return present(M.required_keys(monthly, ["Year", "Month", "ticker"]))


def _sector_batches(spark, sf):
    """Stored rows, and a batch that states each of its keys twice: revised first, as filed last."""
    old = S.sector_rows(V.filings(spark, sf, F.expr(OLD_ORDERS)))
    first = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True)).withColumn("seq", F.lit(1))
    last = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS))).withColumn("seq", F.lit(2))
    return old, last.unionByName(first)


SECTOR_KEYS = ["emiten", "tahun", "triwulan"]


def set_upsert_duplicate_keys(spark, sf):
    from tidemark.operators import merge as M

    old, batch = _sector_batches(spark, sf)
    return present(M.set_upsert(old, batch, SECTOR_KEYS, "seq"))


def replace_upsert_duplicate_keys(spark, sf):
    from tidemark.operators import merge as M

    old, batch = _sector_batches(spark, sf)
    return present(M.replace_upsert(old, batch, SECTOR_KEYS, "seq"))


def merge_outcomes_set(spark, sf):
    from tidemark.operators import merge as M

    old, batch = _sector_batches(spark, sf)
    return M.merge_outcomes(old, batch.filter("seq = 1").drop("seq"), SECTOR_KEYS, mode="set")


def load_keeps_old_stamp(spark, sf):
    from tidemark.operators import merge as M

    old, new = _monthly_pair(spark, sf)
    merged = M.merge(old.withColumn("stamp", F.lit("stored")), new.withColumn("stamp", F.lit("loaded")), ["Year", "Month", "ticker"], null_safe=True, ignore=("stamp",))
    return merged.select("Year", "Month", "ticker", "stamp")


MERGE_QUERIES = [
    "bucketed_upsert_rows",
    "set_upsert_duplicate_keys", "replace_upsert_duplicate_keys", "merge_outcomes_set", "load_keeps_old_stamp",
    "replace_upsert_filings", "set_upsert_rows", "replace_upsert_monthly", "replace_upsert_yearly",
    "last_write_wins", "set_fold_batch", "merge_outcomes", "append_daily", "duplicate_keys", "required_keys",
]


# ---------------------------------------------------------------- ingest
# These queries stage data that Spark derives from the tables into a fresh
# folder under the session's checkpoint folder, then read it back with the
# library's sources.


def ticker_csv(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.sources.staged import read_ticker_csv

    path = scratch_path(spark, "tickers")
    nation = V.table(spark, sf, "nation")
    region = V.table(spark, sf, "region")
    header = spark.range(1).select(F.lit(0).alias("_o"), F.lit(0).alias("_k"), F.lit("﻿emiten").alias("value"))
    names = nation.select(
        F.lit(1).alias("_o"), F.col("n_nationkey").alias("_k"),
        F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit(",ignored")))
        .otherwise(F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))).alias("value"))
    blanks = region.select(
        F.lit(1).alias("_o"), (F.col("r_regionkey") * 5 + 2).alias("_k"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("")).otherwise(F.lit("   ")).alias("value"))
    # The list is one small file with its header first: a bounded dimension.
    (header.unionByName(names).unionByName(blanks).repartition(1)
     .sortWithinPartitions("_o", "_k").select("value").write.text(path))
    return read_ticker_csv(spark, path)


def _stage_monthly(spark, sf, label, path=None):
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json

    path = path or scratch_path(spark, label)
    write_json(R.monthly_average(V.ticks(spark, sf)), path)
    return path


def staged_json_strict(spark, sf):
    from tidemark.schemas import MONTHLY_AGG
    from tidemark.sources.staged import read_staged_json

    return present(read_staged_json(spark, _stage_monthly(spark, sf, "strict"), MONTHLY_AGG, strict=True))


def _stage_with_bad_lines(spark, sf, path=None):
    """Monthly averages, records whose Year is text (mistyped), and lines that are not JSON."""
    from tidemark.sinks.writers import write_json

    path = _stage_monthly(spark, sf, "lenient", path)
    mistyped = V.table(spark, sf, "nation").select(F.col("n_name").alias("Year"), F.lit(1).alias("Month"), F.col("n_name").alias("ticker"))
    write_json(mistyped, path, mode="append")
    broken = V.table(spark, sf, "region").select(F.concat(F.lit('{"Year": 1995, "ticker": "'), F.col("r_name")).alias("value"))
    broken.write.mode("append").text(path)
    return path


def staged_json_lenient(spark, sf):
    from tidemark.schemas import MONTHLY_AGG
    from tidemark.sources.staged import read_staged_json

    return present(read_staged_json(spark, _stage_with_bad_lines(spark, sf), MONTHLY_AGG, strict=False, files="part-*"))


def staged_json_rejects(spark, sf):
    from tidemark.schemas import MONTHLY_AGG
    from tidemark.sources.staged import count_malformed

    return count_malformed(spark, _stage_with_bad_lines(spark, sf), MONTHLY_AGG, files="part-*")


def load_rejects(spark, sf):
    """S8 in the load: the lines it kept aside, from one read of each folder."""
    from tidemark import jobs as J
    from tidemark.session import scratch_path

    base = scratch_path(spark, "load-rejects")
    _stage_with_bad_lines(spark, sf, f"{base}/staged/monthly_aggregation")
    J.load_prices(spark, f"{base}/staged", {"monthly": f"{base}/monthly"}, rejects_path=f"{base}/rejects", files="part-*")
    return spark.read.parquet(f"{base}/rejects").select("aggregation_type", "reason", "line")


def staged_aggregates(spark, sf):
    from tidemark.schemas import DAILY_AGG, MONTHLY_AGG, YEARLY_AGG
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json
    from tidemark.sources.staged import read_aggregate_folders

    base = scratch_path(spark, "aggregates")
    t = V.ticks(spark, sf)
    write_json(R.daily_average(t), f"{base}/daily_aggregation", compression="gzip")
    write_json(R.monthly_average(t), f"{base}/monthly_aggregation", compression="gzip")
    write_json(R.yearly_average(t), f"{base}/yearly_aggregation", compression="gzip")
    df = read_aggregate_folders(
        spark, base,
        {"daily_aggregation": DAILY_AGG, "monthly_aggregation": MONTHLY_AGG, "yearly_aggregation": YEARLY_AGG})
    return present(df.select("aggregation_type", "Date", "Year", "Month", "ticker", "avg_close"))


def staged_parquet(spark, sf):
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_parquet
    from tidemark.sources.staged import read_staged_parquet

    path = scratch_path(spark, "sector-parquet")
    write_parquet(S.sector_rows(V.filings(spark, sf)), path, partition_by=["tahun", "triwulan"])
    return present(read_staged_parquet(spark, path, SECTOR_ROW))


def _archives(spark, sf):
    return V.zip_archives(V.instance_xml(V.filings(spark, sf)))


def archive_members(spark, sf):
    from tidemark.sources import xbrl as XB

    return XB.archive_members(_archives(spark, sf)).select("ticker", "tahun", "triwulan", "member", "status")


def xbrl_facts(spark, sf):
    from tidemark.sources import xbrl as XB

    parsed = XB.parse_facts(V.instance_xml(V.filings(spark, sf)), last_wins=False)
    return XB.facts_long(parsed, ["ticker", "tahun", "triwulan"]).select(
        "ticker", "tahun", "triwulan", "key", "name", "context", "value")


def xbrl_last_wins(spark, sf):
    from tidemark.sources import xbrl as XB

    parsed = XB.parse_facts(V.instance_xml(V.filings(spark, sf), stale_first=True), last_wins=True)
    return XB.facts_long(parsed, ["ticker", "tahun", "triwulan"]).select(
        "ticker", "tahun", "triwulan", "key", "value")


def filing_documents(spark, sf):
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json
    from tidemark.sources import xbrl as XB
    from tidemark.sources.staged import read_filings

    members = XB.archive_members(_archives(spark, sf)).filter(F.col("status") == "ok")
    parsed = XB.parse_facts(members.withColumn("quarter", F.substring("triwulan", 3, 1)).drop("triwulan"))
    docs = XB.filing_documents(parsed, quarter="quarter")
    path = scratch_path(spark, "filings")
    write_json(docs, path, compression="gzip")  # facts repeat their names: a twentieth of the bytes
    back = read_filings(spark, path)
    return back.select(
        "ticker", "tahun", "triwulan",
        F.size("facts").cast("int").alias("n_facts"),
        F.col("file_info.instance_filename").alias("instance_filename"),
        S.fact(S.SECTOR_KEY).alias("sector"),
        S.fact(f"ProfitLoss_{S.D}").alias("net_profit_text"),
    )


def filing_ingest(spark, sf):
    """All archives ingested twice over; every fact of the stored documents."""
    from tidemark import jobs as J
    from tidemark.session import scratch_path

    path = scratch_path(spark, "filing-store")
    for _ in range(2):
        J.ingest_archives(_archives(spark, sf).select("ticker", "tahun", "triwulan", "content"), path)
    facts = spark.read.parquet(path).select("ticker", F.col("tahun").cast("string").alias("tahun"), "triwulan", F.explode("facts").alias("key", "fact"))
    return facts.select("ticker", "tahun", "triwulan", "key", "fact.value")


INGEST_QUERIES = [
    "filing_ingest",
    "ticker_csv", "staged_json_lenient", "staged_json_strict", "staged_aggregates", "staged_parquet",
    "archive_members", "xbrl_facts", "xbrl_last_wins", "filing_documents",
]


# ---------------------------------------------------------------- streaming


def stream_monthly_average(spark, sf):
    """The monthly averages built incrementally: ticks arrive as two file
    drops (before / from 1998), each folded in by one scheduled run."""
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json
    from tidemark.streaming.prices import run_incremental

    base = scratch_path(spark, "stream")
    where = [f"{base}/{x}" for x in ("ticks", "store", "monthly", "_checkpoint")]
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_json(V.ticks(spark, sf, cut), f"{base}/ticks/drop=1", compression="gzip")
    run_incremental(spark, *where)
    write_json(V.ticks(spark, sf, ~cut), f"{base}/ticks/drop=2", compression="gzip")
    return present(run_incremental(spark, *where))


def incremental_averages(spark, sf):
    """A2, A3 between runs: two batches of ticks, of overlapping months, folded into the store of daily sums."""
    from tidemark import jobs as J
    from tidemark.schemas import MONTHLY_AGG, YEARLY_AGG
    from tidemark.session import scratch_path

    base = scratch_path(spark, "partials")
    targets = {g: f"{base}/{g}" for g in ("monthly", "yearly")}
    cut = F.col("l_shipdate") < F.lit("1998-08-15").cast("timestamp_ntz")
    for batch, where in enumerate((cut, ~cut)):
        J.refresh_prices(spark, V.ticks(spark, sf, where), f"{base}/store", targets, batch)
    monthly = spark.read.schema(MONTHLY_AGG).parquet(targets["monthly"]).withColumn("grain", F.lit("monthly"))
    yearly = spark.read.schema(YEARLY_AGG).parquet(targets["yearly"]).withColumn("grain", F.lit("yearly"))
    return monthly.unionByName(yearly, allowMissingColumns=True)


STREAM_QUERIES = ["stream_monthly_average", "incremental_averages"]


# ------------------------------------------------------------------- jobs
# The load jobs end to end, over folders staged from the tables.


def month_to_date_store(spark, sf):
    """The month's ticks from the store that prunes by date, filled by two appends."""
    from datetime import date

    from tidemark.session import scratch_path
    from tidemark.sources import ticks as T

    path = scratch_path(spark, "tick-store")
    cut = F.col("l_shipdate") < F.lit("1998-08-10").cast("timestamp_ntz")
    T.append_ticks(V.ticks(spark, sf, cut), path)
    T.append_ticks(V.ticks(spark, sf, ~cut), path)
    rows = T.month_to_date_ticks(spark, path, date.fromisoformat(MONTH_TO_DATE_AS_OF))
    return present(rows.select("_id", F.col("day").alias("Date"), "ticker", "Close"))


def ingest_prices_job(spark, sf):
    """The pricing frame ingested into the partitioned store, read back without its random ids."""
    from tidemark import jobs as J
    from tidemark.session import scratch_path
    from tidemark.sources.ticks import read_tick_store

    path = scratch_path(spark, "ingest-prices")
    J.ingest_prices(spark, V.raw_ticks(spark, sf), path, partitioned=True)
    ids = F.col("_id").rlike("^[0-9a-f]{24}$") & F.col("fetch_timestamp").isNotNull()
    return read_tick_store(spark, path).select("ticker", "Date", "Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits", ids.alias("has_id"))


def _staged_in_order(spark, sf, path):
    """Sector rows of the new batch, each stated twice, over files of very different sizes.

    As filed, every tenth customer's lie in the first files and all others' in the
    last, the revised rows of all between them: so the last statement of every tenth
    is the revised one. A writer names its files by the order of its tasks.
    """
    from tidemark.sinks.writers import write_json

    filed = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS)))
    revised = S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True))
    tenth = F.substring("emiten", 2, 10).cast("int") % 10 == 0
    stated = filed.withColumn("at", F.when(tenth, 0).otherwise(2)).unionByName(revised.withColumn("at", F.lit(1)))
    write_json(stated.repartitionByRange(7, "at", "emiten").sortWithinPartitions("at", "emiten", "tahun", "triwulan").drop("at"), path)


def load_sector_rows_job(spark, sf):
    """M2, M5, F8, P14 end to end: a first load, then one whose keys are stated twice over several files."""
    from tidemark import jobs as J
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json

    base = scratch_path(spark, "load-rows")
    write_json(S.sector_rows(V.filings(spark, sf, F.expr(OLD_ORDERS))), f"{base}/first")
    J.load_sector_rows(spark, f"{base}/first", f"{base}/target")
    _staged_in_order(spark, sf, f"{base}/second")
    J.load_sector_rows(spark, f"{base}/second", f"{base}/target")
    return present(spark.read.schema(SECTOR_ROW).parquet(f"{base}/target"))


def _stage_prices(spark, sf, base, where, revised=False):
    from tidemark.sinks.writers import write_json

    ticks = (V.revised_ticks if revised else V.ticks)(spark, sf, F.expr(where))
    for kind, rows in (("daily", R.daily_average(ticks)), ("monthly", R.monthly_average(ticks)), ("yearly", R.yearly_average(ticks))):
        write_json(rows.withColumn("Date", F.date_format("Date", "yyyy-MM-dd")) if kind == "daily" else rows, f"{base}/{kind}_aggregation", compression="gzip")


def _two_price_loads(spark, sf):
    from tidemark import jobs as J
    from tidemark.session import scratch_path

    base = scratch_path(spark, "load-prices")
    targets = {k: f"{base}/{k}" for k in ("daily", "monthly", "yearly")}
    _stage_prices(spark, sf, f"{base}/first", OLD_TICKS)
    J.load_prices(spark, f"{base}/first", targets)
    _stage_prices(spark, sf, f"{base}/second", NEW_TICKS, revised=True)
    J.load_prices(spark, f"{base}/second", targets)
    return {k: spark.read.parquet(p) for k, p in targets.items()}


def load_prices_job(spark, sf):
    """M3, M4, M7, K6 end to end: two loads of daily, monthly and yearly averages; the targets."""
    from tidemark.schemas import AVG_COLUMNS

    stored = _two_price_loads(spark, sf)
    return present(stored["daily"].unionByName(stored["monthly"], allowMissingColumns=True).unionByName(stored["yearly"], allowMissingColumns=True)
                   .select("aggregation_type", "Date", F.col("Year").cast("int").alias("Year"), F.col("Month").cast("int").alias("Month"), "ticker", *AVG_COLUMNS))


def load_stamps(spark, sf):
    """The load times that two loads wrote; whether a row has the later one."""
    monthly = _two_price_loads(spark, sf)["monthly"]
    first, n = monthly.agg(F.min("load_timestamp"), F.countDistinct("load_timestamp")).first()
    later = F.col("load_timestamp") > F.lit(first)
    return monthly.select("Year", "Month", "ticker", "aggregation_type", F.lit(n).cast("long").alias("n_stamps"), later.alias("later"))


def transform_filings_job(spark, sf):
    """The transform of one period: filings stored by period, the sector rows of the quarter closed on a day, staged and read back."""
    from datetime import date

    from tidemark import jobs as J
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_parquet
    from tidemark.sources.staged import read_staged_json

    base = scratch_path(spark, "transform")
    write_parquet(S.promote_rule_facts(V.filings(spark, sf)), f"{base}/filings", partition_by=["tahun", "triwulan"], compression="zstd")
    seen = J.transform_filings(spark, f"{base}/filings", f"{base}/rows", fmt="parquet", as_of=date(1997, 8, 1))
    rows = present(read_staged_json(spark, f"{base}/rows", SECTOR_ROW))
    return rows.withColumn("counted", F.lit(seen["rows"]).cast("long")).withColumn("null_sector", F.lit(seen["null_sector"]).cast("long"))


def documents_per_ticker(spark, sf):
    """K5: every filing's document in a folder of its own, read back, with the files that hold it."""
    from tidemark.schemas import FILING
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import read_documents, write_documents

    path = scratch_path(spark, "documents")
    write_documents(V.filings(spark, sf), path)
    back = read_documents(spark, path, FILING, file="file").select("ticker", "tahun", "triwulan", "facts", "file")
    net = S.fact(f"ProfitLoss_{S.D}")
    return back.groupBy("ticker", "tahun", "triwulan").agg(
        F.countDistinct("file").alias("n_files"), F.count("*").alias("n_documents"), F.max(F.size("facts")).cast("int").alias("n_facts"),
        F.max(S.fact(S.SECTOR_KEY)).alias("sector"), F.max(net).alias("net_profit_text"))


def load_refuses_duplicates(spark, sf):
    """M8: a target in which every tenth customer's rows stand twice; the load is refused, and the target is as it was."""
    from tidemark import jobs as J
    from tidemark.operators.merge import DuplicateKeys
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json, write_parquet

    base = scratch_path(spark, "load-refused")
    rows = S.sector_rows(V.filings(spark, sf, F.expr(OLD_ORDERS)))
    twice = rows.unionByName(rows.filter(F.substring("emiten", 2, 10).cast("int") % 10 == 0))
    write_parquet(twice, f"{base}/target", partition_by=["tahun", "triwulan"])
    write_json(S.sector_rows(V.filings(spark, sf, F.expr(NEW_ORDERS), revised=True)), f"{base}/staged")
    refused = False
    try:
        J.load_sector_rows(spark, f"{base}/staged", f"{base}/target")
    except DuplicateKeys:
        refused = True
    stored = spark.read.schema(SECTOR_ROW).parquet(f"{base}/target")
    return present(stored.groupBy("emiten", "tahun", "triwulan").agg(F.count("*").alias("n"), F.max("total_assets").alias("total_assets")).withColumn("refused", F.lit(refused)))


JOB_QUERIES = ["month_to_date_store", "ingest_prices_job", "load_sector_rows_job", "load_prices_job", "load_stamps", "load_rejects", "load_refuses_duplicates",
               "transform_filings_job", "documents_per_ticker", "sorted_json"]


def ticker_lines(spark, sf):
    """A plain ticker list (lines may hold commas), header line skipped."""
    from tidemark.session import scratch_path
    from tidemark.sources.staged import read_ticker_lines

    path = scratch_path(spark, "ticker-lines")
    nation = V.table(spark, sf, "nation")
    header = spark.range(1).select(F.lit(0).alias("_o"), F.lit(0).alias("_k"), F.lit("emiten").alias("value"))
    lines = nation.select(F.lit(1).alias("_o"), F.col("n_nationkey").alias("_k"),
                          F.concat(F.lit(" "), F.col("n_name"), F.lit(","), F.col("n_regionkey").cast("string"),
                                   F.lit("  ")).alias("value"))
    (header.unionByName(lines).repartition(1).sortWithinPartitions("_o", "_k")
     .select("value").write.text(path))
    return read_ticker_lines(spark, path)


def tick_appends(spark, sf):
    """K7 + S6: ticks appended per batch (two batches), read back with the TICK schema."""
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import append
    from tidemark.sources.ticks import read_ticks

    path = scratch_path(spark, "tick-appends")
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    append(V.ticks(spark, sf, cut), path, fmt="json")
    append(V.ticks(spark, sf, ~cut), path, fmt="json")
    return read_ticks(spark, path).select("_id", "Date", "ticker", "Open", "Close", "Volume", "fetch_timestamp")


def unparsed_facts(spark, sf):
    """Facts beyond a plain amount: one of 10^12 times the assets, one of six decimals, and one that is no number."""
    fl = V.filings(spark, sf)
    whole = F.split_part(S.fact(f"Assets_{S.I}"), F.lit("."), F.lit(1))
    wide, text = F.concat(whole, F.lit("0" * 12)), F.when(whole != "", F.concat(whole, F.lit(" million")))
    facts = F.array(wide, F.lit("1.234567"), text)
    count = F.size(F.filter(facts, X.not_a_number))
    return present(fl.select("ticker", "tahun", "triwulan", X.money(wide).alias("wide"), X.money(F.lit("1.234567")).alias("fine"),
                             count.cast("int").alias("n_unparsed"), F.when(X.num(wide).isNotNull(), 1).cast("int").alias("n_parsed")))


def avg_fine_grained(spark, sf):
    """Averages of values below 10^-6 and of twelve decimals."""
    t = V.ticks(spark, sf)
    t = t.withColumn("High", F.col("Open") * 0.123456789123).withColumn("Open", F.col("Open") * 0.0000000012345)
    return present(R.daily_average(t)).select("Date", "ticker", F.col("avg_open").alias("tiny"), F.col("avg_high").alias("fine"))


def target_names(spark, sf):
    """K8: the names of all periods the orders fall in."""
    y, q = PD.latest_closed_period(F.col("o_orderdate").cast("date"))
    periods = V.table(spark, sf, "orders").select(y.cast("long").alias("year"), q.cast("int").alias("quarter")).distinct()
    return periods.withColumn("name", PD.target_name("filings_", F.col("year"), F.col("quarter"), "_raw"))


def surrogate_ids(spark, sf):
    """How many ids, how many distinct, how many not of 24 hex characters."""
    ids = V.table(spark, sf, "lineitem").select(X.surrogate_id().alias("id"))
    return ids.agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_distinct"), F.count(F.when(~F.col("id").rlike("^[0-9a-f]{24}$"), 1)).cast("int").alias("n_bad"))


def canonical_columns(spark, sf):
    """All sector rows, their columns in another order and one more between them, put in order again; each row as text."""
    from tidemark.schemas import SECTOR_COLUMNS

    rows = S.sector_rows(V.filings(spark, sf)).withColumn("extra", F.lit("end"))
    shuffled = rows.select(*sorted(rows.columns, key=lambda c: c[::-1]))
    back = X.canonical_order(shuffled, SECTOR_COLUMNS)
    return back.select("emiten", "tahun", "triwulan", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in back.columns]).alias("row_text"))


def _out_of_order(back: DataFrame) -> DataFrame:
    """Rows (emiten, file, at): by name, how many stand behind a greater one, within their file or in the files before."""
    from pyspark.sql import Window

    inside = F.lag("emiten").over(Window.partitionBy("file").orderBy("at"))
    files = back.groupBy("file").agg(F.min("emiten").alias("low"), F.max("emiten").alias("high"))
    # The files, some per task, in the order of their names.
    files = files.withColumn("before", F.lag("high").over(Window.orderBy("file"))).select(F.col("file").alias("f"), "before")
    placed = back.withColumn("last", inside).join(files, F.col("file") == F.col("f"))
    wrong = F.coalesce(F.col("last") > F.col("emiten"), F.lit(False)) | F.coalesce(F.col("before") > F.col("emiten"), F.lit(False))
    return placed.groupBy("emiten").agg(F.count(F.when(wrong, 1)).cast("int").alias("out_of_order"), F.count("*").alias("n"))


def sorted_json(spark, sf):
    """K1: sector rows as sorted JSON, read back by file and line: rows before which a greater name stands."""
    from tidemark.schemas import SECTOR_ROW
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_json_sorted
    from tidemark.sources.staged import ORDER, read_staged_json

    path = scratch_path(spark, "sorted-json")
    write_json_sorted(S.sector_rows(V.filings(spark, sf)), path)
    back = read_staged_json(spark, path, SECTOR_ROW, ordered=True)
    return _out_of_order(back.select("emiten", F.col(ORDER)["file"].alias("file"), F.col(ORDER).alias("at")))


def sorted_staging(spark, sf):
    """K4, O1: the sorted collection, read back by place: rows before which a greater name stands."""
    from tidemark.session import scratch_path
    from tidemark.sinks.writers import write_collection

    path = scratch_path(spark, "sorted")
    write_collection(S.sector_rows(V.filings(spark, sf)), path)
    return _out_of_order(spark.read.parquet(path).select("emiten", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")))


def counted_writes(spark, sf):
    """Each sector's rows, counted as they are written and again where they are; a sector nobody has is refused."""
    from tidemark.session import scratch_path
    from tidemark.sinks import writers as W
    from tidemark.sources.staged import exists

    base, out = scratch_path(spark, "counted"), None
    # The filings are made once, and stored with what the branches read of them.
    W.write_parquet(S.promote_rule_facts(V.filings(spark, sf)).drop("facts"), f"{base}/filings", compression="zstd")
    filings = spark.read.parquet(f"{base}/filings")
    for k, sector in enumerate([*S.SECTORS, "nobody's"]):
        path = f"{base}/{k}"
        branch = S.sector_branch(filings, sector) if sector in S.SECTORS else S.sector_rows(filings.filter(S.sector_of(filings) == sector))
        written = 0
        try:
            W.guard_empty(branch, on_empty="fail")
            counted, seen = W.counted(branch)
            W.write_parquet(counted, path)
            written = seen.get["rows"]
        except W.EmptyInput:
            pass
        stored = spark.read.parquet(path) if exists(spark, path) else branch
        one = stored.agg(F.lit(sector).alias("sector"), F.lit(written).cast("long").alias("counted"), F.count("*").alias("stored"), F.lit(exists(spark, path)).alias("written"))
        out = one if out is None else out.unionByName(one)
    return out


def processed_dates(spark, sf):
    """Documents, and those whose processing time is ISO text."""
    from tidemark.sources import xbrl as XB

    members = XB.archive_members(_archives(spark, sf)).filter(F.col("status") == "ok")
    docs = XB.filing_documents(XB.parse_facts(members.withColumn("quarter", F.substring("triwulan", 3, 1)).drop("triwulan")), quarter="quarter")
    iso = F.col("processed_date")["$date"].rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\\.[0-9]{6}$")
    return docs.agg(F.count("*").alias("n"), F.count(F.when(iso, 1)).alias("n_iso"))


def malformed_instances(spark, sf):
    """Instances of every fifth customer are cut short; what the parse says of them."""
    from tidemark.sources import xbrl as XB

    xml = V.instance_xml(V.filings(spark, sf))
    cut = F.substring("ticker", 2, 5).cast("int") % 5 == 0
    parsed = XB.parse_facts(xml.withColumn("xbrl", F.when(cut, F.expr("substring(xbrl, 1, length(xbrl) - 5)")).otherwise(F.col("xbrl"))))
    return parsed.groupBy("status").agg(F.count("*").alias("n"))


INGEST_QUERIES += ["ticker_lines", "tick_appends", "staged_json_rejects", "unparsed_facts", "avg_fine_grained", "target_names", "surrogate_ids",
                   "canonical_columns", "sorted_staging", "counted_writes", "processed_dates", "malformed_instances"]
