"""Benchmark: the headline workloads at one scale, one JSON line out.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3; the median is reported).

Inputs are derived from the driver's tables once and stored as Parquet
under the session's checkpoint folder (ticks, filing documents, sector
rows), so each timing measures the operator reading stored data, the way a
scheduled job would. Every timed query runs to completion through the
`noop` sink (no collect to the driver).

sector rules as a five-branch union vs one CASE pass; replace- and
set-upserts with 1 %, 10 % and 50 % incoming rows; the load jobs end to end; the
archive scan; XBRL fact extraction with the instances in 1 partition vs spread
over all cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark import jobs as J  # noqa: E402
from tidemark.operators import merge as M  # noqa: E402
from tidemark.operators import partials as PT  # noqa: E402
from tidemark.operators import rollup as R  # noqa: E402
from tidemark.operators import sectors as S  # noqa: E402
from tidemark.plans import views as V  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import xbrl as XB  # noqa: E402
from tidemark.sources.keyed import read_keyed, write_keyed  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="tidemark-bench")

    # ---- setup (untimed): stored inputs
    # Stored inputs are spread over 2 x cores files, as a large input would be
    # over many files, so every variant gets the same scan parallelism.
    files = 2 * cpus
    base = scratch_path(spark, "bench")
    V.ticks(spark, sf_dir).repartition(files).write.parquet(f"{base}/ticks")
    V.filings(spark, sf_dir).repartition(files).write.parquet(f"{base}/filings")
    ticks = spark.read.parquet(f"{base}/ticks")
    filings = spark.read.parquet(f"{base}/filings")
    S.promote_rule_facts(filings).write.parquet(f"{base}/filings_promoted")
    promoted = spark.read.parquet(f"{base}/filings_promoted")
    S.sector_rows(filings).repartition(files).write.parquet(f"{base}/sector_rows")
    rows = spark.read.parquet(f"{base}/sector_rows")
    V.instance_xml(filings).write.parquet(f"{base}/instances")
    xml = spark.read.parquet(f"{base}/instances")
    keys = ["emiten", "tahun", "triwulan"]
    fkeys = ["ticker", "tahun", "triwulan"]
    bucket = F.abs(F.xxhash64(*keys)) % 100
    fbucket = F.abs(F.xxhash64(*fkeys)) % 100
    # Incoming batches: a share of the keys with changed values, plus new keys.
    for pct in (1, 10, 50):
        chg = rows.filter(bucket < pct).withColumn("revenue", F.col("revenue") + F.lit(1)) \
            .withColumn("cash", F.lit(None).cast(rows.schema["cash"].dataType))
        new = rows.filter(bucket < pct).withColumn("tahun", F.concat(F.lit("N"), F.col("tahun")))
        chg.unionByName(new).write.parquet(f"{base}/incoming_rows_{pct}")
        fchg = filings.filter(fbucket < pct).withColumn("tahun", F.concat(F.lit("N"), F.col("tahun")))
        filings.filter(fbucket < pct).unionByName(fchg).write.parquet(f"{base}/incoming_filings_{pct}")

    buckets = max(8, cpus * 2)
    write_keyed(rows, f"{base}/keyed_rows", keys, buckets)
    write_keyed(filings, f"{base}/keyed_filings", fkeys, buckets)
    keyed_rows, keyed_filings = read_keyed(spark, f"{base}/keyed_rows", rows.schema, keys, buckets), read_keyed(spark, f"{base}/keyed_filings", filings.schema, fkeys, buckets)

    n_in = {"ticks": ticks.count(), "filings": filings.count(), "sector_rows": rows.count()}

    q: dict[str, float] = {}
    q["rollup_three_scans"] = timed(lambda: (run_noop(R.daily_average(ticks)), run_noop(R.monthly_average(ticks)),
                                             run_noop(R.yearly_average(ticks))), runs)
    q["rollup_grouping_sets"] = timed(lambda: run_noop(R.all_grains(ticks)), runs)
    q["sectors_five_branch_union"] = timed(lambda: run_noop(S.sector_rows_union(filings)), runs)
    q["sectors_one_pass"] = timed(lambda: run_noop(S.sector_rows(filings)), runs)
    q["sectors_one_pass_promoted"] = timed(lambda: run_noop(S.sector_rows(promoted)), runs)
    for pct in (1, 10, 50):
        inc_f = spark.read.parquet(f"{base}/incoming_filings_{pct}")
        inc_r = spark.read.parquet(f"{base}/incoming_rows_{pct}")
        q[f"replace_upsert_{pct}pct"] = timed(lambda: run_noop(M.replace_upsert(filings, inc_f, fkeys)), runs)
        q[f"set_upsert_{pct}pct"] = timed(lambda: run_noop(M.set_upsert(rows, inc_r, keys)), runs)
        # The target in buckets of its keys, and a batch that states each key once: neither a fold nor a shuffle of the target.
        q[f"set_upsert_bucketed_{pct}pct"] = timed(lambda: run_noop(M.set_upsert(keyed_rows, inc_r, keys, unique=True)), runs)
        q[f"replace_upsert_bucketed_{pct}pct"] = timed(lambda: run_noop(M.replace_upsert(keyed_filings, inc_f, fkeys, unique=True)), runs)
    inc = spark.read.parquet(f"{base}/incoming_rows_10")
    q["merge_outcomes_10pct"] = timed(lambda: run_noop(M.merge_outcomes(rows, inc, keys, mode="set")), runs)
    # Jobs end to end: the first load makes the target, the timed ones merge into it.
    inc.write.json(f"{base}/staged_rows")
    J.load_sector_rows(spark, f"{base}/staged_rows", f"{base}/target_rows")
    q["job_load_sector_rows"] = timed(lambda: J.load_sector_rows(spark, f"{base}/staged_rows", f"{base}/target_rows"), 1)
    ticks.write.json(f"{base}/ticks_json")
    J.transform_prices(spark, f"{base}/ticks_json", f"{base}/staged_prices")
    targets = {k: f"{base}/target_{k}" for k in ("daily", "monthly", "yearly")}
    J.load_prices(spark, f"{base}/staged_prices", targets)
    q["job_load_prices"] = timed(lambda: J.load_prices(spark, f"{base}/staged_prices", targets), 1)
    archives = V.zip_archives(xml)
    archives.write.parquet(f"{base}/archives")
    q["archive_scan"] = timed(lambda: run_noop(XB.archive_members(spark.read.parquet(f"{base}/archives"))), 1)
    q["archive_facts"] = timed(lambda: run_noop(XB.archive_facts(spark.read.parquet(f"{base}/archives"))), 1)
    # A weekday's run: the last month's ticks folded into stored sums, its month and year recomputed.
    PT.fold(ticks, f"{base}/sums", 0)
    late = ticks.filter(F.col("Date") >= "1998-11-01")
    q["job_refresh_prices"] = timed(lambda: J.refresh_prices(spark, late, f"{base}/sums", {"monthly": f"{base}/m", "yearly": f"{base}/y"}, 1), 1)
    # One run only: a single-task scaling reference, not a headline.
    q["xbrl_parse_1_partition"] = timed(lambda: run_noop(XB.parse_facts(xml.coalesce(1))), 1)
    q["xbrl_parse_all_cores"] = timed(lambda: run_noop(XB.parse_facts(xml.repartition(cpus))), runs)

    headline = ["rollup_grouping_sets", "sectors_one_pass_promoted", "replace_upsert_10pct", "set_upsert_10pct",
                "xbrl_parse_all_cores"]
    sf_name = os.path.basename(sf_dir.rstrip("/"))
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(q[k] for k in headline), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": sf_name.replace("sf", ""),
        "cores": cpus,
        "runs": runs,
        "spark": spark.version,
        "rows_in": n_in,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
