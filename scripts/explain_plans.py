"""Write PLANS.md: executed physical plans of the headline operators.

Usage: python scripts/explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)

Inputs are stored as Parquet first (as the jobs would read them). Each plan
is taken after execution, so AQE's final choices (broadcast conversions,
coalesced partitions) and the whole-stage codegen markers `*(n)` are shown.
Only the operator lines and the scan details are kept.
"""

from __future__ import annotations

import os
import re
import sys
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import merge as M  # noqa: E402
from tidemark.operators import partials as PT  # noqa: E402
from tidemark.operators import rollup as R  # noqa: E402
from tidemark.operators import sectors as S  # noqa: E402
from tidemark.plans import views as V  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import ticks as T  # noqa: E402
from tidemark.sources import xbrl as XB  # noqa: E402
from tidemark.sources.keyed import read_keyed, write_keyed  # noqa: E402

KEEP = re.compile(r"(Scan|Exchange|Join|Aggregate|Expand|Window|Sort|Project|Filter|Union|MapInArrow|"
                  r"BroadcastExchange|AdaptiveSparkPlan|WholeStageCodegen|Coalesce|AQEShuffleRead)")


def final_plan(df) -> str:
    # Run this DataFrame's own QueryExecution (JVM side, nothing collected)
    # so its adaptive plan is final, then print it.
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def trimmed(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        if "FileScan" in line:
            head = line.split(" Batched:")[0]
            bucketed = " Bucketed: true" if "Bucketed: true" in line else ""
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            parts = re.search(r"PartitionFilters: (\[[^\]]+\])", line)
            schema = re.search(r"ReadSchema: (\S+)", line)
            indent = " " * (len(line) - len(line.lstrip()) + 3)
            out.append(head + bucketed)
            out.append(f"{indent}PushedFilters: {pushed.group(1) if pushed else '[]'}")
            if parts:
                out.append(f"{indent}PartitionFilters: {parts.group(1)}")
            rs = schema.group(1) if schema else ""
            out.append(f"{indent}ReadSchema: {rs if len(rs) < 400 else rs[:397] + '...'}")
            continue
        if len(line) > 260:
            line = line[:257] + "..."
        out.append(line)
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores=8, shuffle_partitions=8, app="tidemark-plans")
    base = scratch_path(spark, "plans")
    V.ticks(spark, sf).write.parquet(f"{base}/ticks")
    V.filings(spark, sf).write.parquet(f"{base}/filings")
    ticks = spark.read.parquet(f"{base}/ticks")
    filings = spark.read.parquet(f"{base}/filings")
    S.promote_rule_facts(filings).write.parquet(f"{base}/promoted")
    promoted = spark.read.parquet(f"{base}/promoted")
    S.sector_rows(filings).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    small = rows.filter(F.abs(F.xxhash64("emiten", "tahun", "triwulan")) % 100 < 5)
    keys = ["emiten", "tahun", "triwulan"]
    rows.write.partitionBy("tahun", "triwulan").parquet(f"{base}/stored_rows")
    stored = spark.read.schema(rows.schema).parquet(f"{base}/stored_rows")
    batch = rows.filter("tahun = '1997' AND triwulan = 'TW2'")
    V.instance_xml(filings).write.parquet(f"{base}/xml")
    xml = spark.read.parquet(f"{base}/xml")

    write_keyed(rows, f"{base}/keyed", keys, 8)
    keyed = read_keyed(spark, f"{base}/keyed", rows.schema, keys, 8)
    T.append_ticks(V.ticks(spark, sf), f"{base}/tick_store")
    PT.fold(V.ticks(spark, sf), f"{base}/sums", 0)
    PT.fold(V.ticks(spark, sf, F.expr("l_shipdate >= TIMESTAMP_NTZ'1998-11-01 00:00:00'")), f"{base}/sums", 1)
    months = PT.read_store(spark, f"{base}/sums").filter(PT.touched(spark, f"{base}/sums", 1, ["Year", "Month"]))

    cases = [
        ("A1-A3 in one scan (`rollup.all_grains`)", R.all_grains(ticks)),
        ("R1-R13 one pass on the promoted layout, one period (`sectors.sector_rows`)",
         S.sector_rows(promoted.filter(F.col("tahun") == "1998"))),
        ("R1-R13 one pass on the map (`sectors.sector_rows`)", S.sector_rows(filings)),
        ("M1 replace-upsert, small batch (`merge.replace_upsert`)", M.replace_upsert(rows, small, keys)),
        ("M2 set-upsert, small batch (`merge.set_upsert`)", M.set_upsert(rows, small, keys)),
        ("A load's merge: the target's touched partitions only (`jobs.merge_into`)",
         M.merge(stored.filter("tahun = '1997' AND triwulan = 'TW2'"), batch, keys, "set")),
        ("M2 set-upsert into a bucketed target, which is not shuffled (`sources.keyed`, `merge.set_upsert`)", M.set_upsert(keyed, small, keys)),
        ("D5 month to date on the partitioned tick store (`ticks.month_to_date_ticks`)", T.month_to_date_ticks(spark, f"{base}/tick_store", date(1998, 8, 20))),
        ("A2 from stored sums: the months a batch touched (`partials.refresh`)", PT.averages_of(months, "monthly")),
        ("M5 last write wins (`merge.last_write_wins`)",
         M.last_write_wins(V.ticks_with_seq(spark, sf).select("Date", "ticker", "seq", "Open"), ["Date", "ticker"])),
        ("S4 XBRL parse (`xbrl.parse_facts`)", XB.parse_facts(xml)),
    ]
    parts = ["# Physical plans\n",
             f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf.rstrip('/'))}`, local[8], "
             f"Spark {spark.version}. Final adaptive plans after execution; `*(n)` marks whole-stage codegen. "
             "Only operator and scan lines are kept.\n"]
    for title, df in cases:
        parts.append(f"## {title}\n\n```\n{trimmed(final_plan(df))}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
