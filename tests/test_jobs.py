"""The four scheduled steps end to end on derived data."""

from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.operators import rollup as R
from tidemark.operators import sectors as S
from tidemark.plans import views as V
from tidemark.sinks.writers import write_json


def test_filings_transform_and_load(spark, sf, tmp_path):
    d = str(tmp_path)
    V.filings(spark, sf).write.json(f"{d}/filings")
    summary = J.transform_filings(spark, f"{d}/filings", f"{d}/staged")
    expected = S.sector_rows(V.filings(spark, sf))
    assert summary["rows"] == expected.count() and summary["null_sector"] == S.dropped_null_sector(V.filings(spark, sf)).count() > 0
    assert J.load_sector_rows(spark, f"{d}/staged", f"{d}/target") == {"inserted": expected.count()}
    assert J.load_sector_rows(spark, f"{d}/staged", f"{d}/target") == {"unchanged": expected.count()}
    stored = spark.read.schema(expected.schema).parquet(f"{d}/target")
    assert stored.exceptAll(expected.select(*stored.columns)).count() == 0 and stored.count() == expected.count()


def test_one_period_is_transformed_and_loaded(spark, sf, tmp_path):
    d, day = str(tmp_path), date(1997, 8, 1)  # the closed period is 1997, quarter 2
    V.filings(spark, sf).write.json(f"{d}/filings")
    J.transform_filings(spark, f"{d}/filings", f"{d}/all")
    J.load_sector_rows(spark, f"{d}/all", f"{d}/target")
    before = {f: f.stat().st_mtime_ns for f in tmp_path.glob("target/tahun=*/triwulan=*/*.parquet")}
    got = J.transform_filings(spark, f"{d}/filings", f"{d}/one", as_of=day)
    n = S.sector_rows(V.filings(spark, sf)).filter("tahun = '1997' AND triwulan = 'TW2'").count()
    assert got["rows"] == n > 0
    assert J.load_sector_rows(spark, f"{d}/one", f"{d}/target", as_of=day) == {"unchanged": n}
    after = {f: f.stat().st_mtime_ns for f in tmp_path.glob("target/tahun=*/triwulan=*/*.parquet")}
    assert {f.parent for f in set(after.items()) ^ set(before.items()) for f in [f[0]]} == {tmp_path / "target/tahun=1997/triwulan=TW2"}


def test_duplicate_staged_keys_become_one_row(spark, tmp_path):
    (tmp_path / "staged").mkdir()
    (tmp_path / "staged" / "part-0.json").write_text(
        '{"emiten": "A", "tahun": "2024", "triwulan": "TW1", "revenue": 1.0}\n{"emiten": "A", "tahun": "2024", "triwulan": "TW1", "gross_profit": 2.0}\n')
    assert J.load_sector_rows(spark, f"{tmp_path}/staged", f"{tmp_path}/target") == {"inserted": 1}
    row = spark.read.parquet(f"{tmp_path}/target").first()
    assert (row.revenue, row.gross_profit) == (1.0, 2.0)


def test_prices_transform_and_load(spark, sf, tmp_path):
    d = str(tmp_path)
    ticks = V.ticks(spark, sf)
    write_json(ticks, f"{d}/ticks")
    counts = J.transform_prices(spark, f"{d}/ticks", f"{d}/staged")
    assert counts["monthly"] == R.monthly_average(ticks).count()
    targets = {k: f"{d}/{k}" for k in ("daily", "monthly", "yearly")}
    out = J.load_prices(spark, f"{d}/staged", targets)
    assert out["monthly"] == {"inserted": counts["monthly"], "rejected": 0}
    out2 = J.load_prices(spark, f"{d}/staged", targets)
    assert out2["yearly"] == {"unchanged": counts["yearly"], "rejected": 0}
    assert spark.read.parquet(targets["daily"]).count() == 2 * counts["daily"]  # append duplicates (M7)
    m = spark.read.parquet(targets["monthly"]).drop("aggregation_type", "load_timestamp")
    want = R.monthly_average(ticks)
    assert m.count() == counts["monthly"] and m.select(want.columns).exceptAll(want).count() == 0
    daily = {**targets, "daily": f"{d}/daily_by_key"}
    J.load_prices(spark, f"{d}/staged", daily, upsert_daily=True)
    assert J.load_prices(spark, f"{d}/staged", daily, upsert_daily=True)["daily"]["unchanged"] == counts["daily"]


def test_stored_rows_keep_their_load_time(spark, tmp_path):
    d = str(tmp_path)
    line = '{"Year": %d, "Month": 1, "ticker": "A", "avg_open": 1.0}\n'
    folder = tmp_path / "staged" / "monthly_aggregation"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(line % 2023 + line % 2024 + "not json\n")
    assert J.load_prices(spark, f"{d}/staged", {"monthly": f"{d}/m"})["monthly"] == {"inserted": 2, "rejected": 1}
    first = {r.Year: r.load_timestamp for r in spark.read.parquet(f"{d}/m").collect()}
    (folder / "part-0.json").write_text(line % 2024)
    J.load_prices(spark, f"{d}/staged", {"monthly": f"{d}/m"})
    then = {r.Year: r.load_timestamp for r in spark.read.parquet(f"{d}/m").collect()}
    assert then[2023] == first[2023] and then[2024] > first[2024]


def test_archives_are_ingested(spark, sf, tmp_path):
    """Real archive files on shared storage, one of them with a malformed instance."""
    import zipfile

    docs = V.instance_xml(V.filings(spark, sf)).limit(4).collect()
    for k, r in enumerate(docs):
        folder = tmp_path / "archives" / "2024" / "TW1" / f"T{k}"
        folder.mkdir(parents=True)
        with zipfile.ZipFile(folder / "instance.zip", "w") as zf:
            zf.writestr("instance.xbrl", "<broken" if k == 3 else r.xbrl)
    got = J.ingest_filings(spark, f"{tmp_path}/archives", f"{tmp_path}/filings", f"{tmp_path}/status", as_of=date(2024, 5, 1))
    assert got == {"inserted": 3, "status_ok": 3, "status_parse_error": 1}
    again = J.ingest_filings(spark, f"{tmp_path}/archives", f"{tmp_path}/filings")
    assert again["unchanged"] == 3
    rows = J.transform_filings(spark, f"{tmp_path}/filings", f"{tmp_path}/staged", fmt="parquet", as_of=date(2024, 5, 1))
    assert rows["rows"] + rows["null_sector"] == 3


def test_whole_documents_are_stored(spark, sf, tmp_path):
    """Facts that no rule reads are stored too, and a change of one is an update."""
    import io
    import zipfile

    def ingest(xml):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as zf:
            zf.writestr("instance.xbrl", xml)
        rows = spark.createDataFrame([("T", "2024", "TW1", bytearray(buffer.getvalue()))], "ticker string, tahun string, triwulan string, content binary")
        return J.ingest_archives(rows, f"{tmp_path}/filings")

    xml = V.instance_xml(V.filings(spark, sf)).limit(1).first().xbrl
    end = xml.rindex("</")
    other = lambda v: xml[:end] + f'<SomeOtherFact contextRef="CurrentYearInstant">{v}</SomeOtherFact>' + xml[end:]
    assert ingest(other("1")) == {"inserted": 1, "status_ok": 1}
    assert ingest(other("1")) == {"unchanged": 1, "status_ok": 1}
    assert ingest(other("2")) == {"updated": 1, "status_ok": 1}
    row = spark.read.parquet(f"{tmp_path}/filings").first()
    assert row.file_info.instance_filename == "instance.xbrl" and row.processed_date and row.rule_facts
    assert [v.value for k, v in row.facts.items() if "SomeOtherFact" in k] == ["2"]


def test_prices_are_ingested_and_the_older_load(spark, sf, tmp_path):
    frame = V.raw_ticks(spark, sf)
    assert J.ingest_prices(spark, frame, f"{tmp_path}/ticks") == {"appended": frame.count()}
    ids = [r._id for r in spark.read.json(f"{tmp_path}/ticks").select("_id").collect()]
    assert len(set(ids)) == len(ids) and all(len(i) == 24 and int(i, 16) >= 0 for i in ids)
    rows = S.sector_rows(V.filings(spark, sf))
    rows.write.parquet(f"{tmp_path}/handoff")
    assert J.load_single_job(spark, f"{tmp_path}/handoff", f"{tmp_path}/collection") == {"rows": rows.count()}
    assert J.load_single_job(spark, f"{tmp_path}/none", f"{tmp_path}/collection") == {"rows": 0}


def test_filings_transform_on_promoted_parquet(spark, sf, tmp_path):
    d = str(tmp_path)
    S.promote_rule_facts(V.filings(spark, sf)).write.parquet(f"{d}/promoted")
    summary = J.transform_filings(spark, f"{d}/promoted", f"{d}/staged", fmt="parquet", single_file=True)
    expected = S.sector_rows(V.filings(spark, sf))
    assert summary["rows"] == expected.count()
    staged = spark.read.schema(expected.schema).json(f"{d}/staged")
    assert staged.exceptAll(expected).count() == 0
    emitens = [r.emiten for r in staged.select("emiten").collect()]
    assert emitens == sorted(emitens)


def test_archive_files_through_binary_file(spark, sf, tmp_path):
    """S3: every archive a file of its own, in partition-style folders, ingested from the files; a period limits what is read."""
    archives = V.zip_archives(V.instance_xml(V.filings(spark, sf, F.expr("o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00'"))))
    V.write_archive_files(archives, str(tmp_path / "archives"))
    seen = J.ingest_filings(spark, str(tmp_path / "archives"), str(tmp_path / "filings"), str(tmp_path / "status"), pattern="part-*")
    n = archives.count()
    status = spark.read.parquet(str(tmp_path / "status"))
    assert status.count() == n and seen["inserted"] == status.filter("status = 'ok'").count() == seen["status_ok"]
    stored = spark.read.parquet(str(tmp_path / "filings"))
    assert stored.filter("size(facts) > 0 AND file_info.file_size > 0 AND ticker LIKE 'C%'").count() == seen["inserted"]
    one = J.ingest_filings(spark, str(tmp_path / "archives"), str(tmp_path / "period"), as_of=date(1998, 5, 2), pattern="part-*")
    got = spark.read.parquet(str(tmp_path / "period")).select("tahun", "triwulan").distinct().collect()
    assert [tuple(map(str, r)) for r in got] == [("1998", "TW1")] and one["inserted"] > 0


def test_the_last_archive_of_a_key_counts(spark, tmp_path):
    """Of two archives of one filing the one with the later path, whatever their sizes."""
    import io
    import zipfile

    for name, value, pad in (("a.zip", "1", 50_000), ("b.zip", "2", 1)):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            z.writestr("instance.xbrl", f'<r><F contextRef="c">{value}</F><G contextRef="c">{"x" * pad}</G></r>')
        folder = tmp_path / "in" / "2024" / "TW1" / "AAA"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(body.getvalue())
    J.ingest_filings(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).select(F.col("facts")["F_c"]["value"]).collect() == [("2",)]


def test_records_count_in_the_order_of_file_names(spark, tmp_path):
    """A small first file against a large second one: Spark reads the large one first."""
    keys = '"emiten":"X","tahun":"2024","triwulan":"TW1"'
    (tmp_path / "part-00000.json").write_text(f'{{{keys},"revenue":1,"cash":5}}\n')
    others = "".join(f'{{"emiten":"Y{k}","tahun":"2024","triwulan":"TW1","revenue":{k}}}\n' for k in range(300))
    (tmp_path / "part-00001.json").write_text(others + f'{{{keys},"revenue":2}}\n')
    J.load_sector_rows(spark, str(tmp_path), str(tmp_path / "target"))
    x = spark.read.parquet(str(tmp_path / "target")).filter("emiten = 'X'").first()
    assert (int(x["revenue"]), int(x["cash"])) == (2, 5)


def test_rejects_are_kept_with_place_and_reason(spark, tmp_path):
    folder = tmp_path / "staged" / "monthly_aggregation"
    folder.mkdir(parents=True)
    lines = ['{"Year":2024,"Month":1,"ticker":"A","avg_open":1.5}', "not json", '["list"]', '{"Year":"x","Month":2,"ticker":"B"}', '{"Year":2024,"Month":3,"ticker":"C"} trailing', "", '{"Year":2024,"Month":4,"ticker":"D","avg_open":"NaN"}', "null"]
    (folder / "part-00000.json").write_text("\n".join(lines) + "\n")
    out = J.load_prices(spark, str(tmp_path / "staged"), {"monthly": str(tmp_path / "monthly")}, rejects_path=str(tmp_path / "rejects"))
    assert (out["monthly"]["rejected"], out["monthly"]["mistyped"], out["monthly"]["inserted"]) == (4, 1, 3)
    kept = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert {(r["line"], r["reason"]) for r in kept} == {("not json", "not JSON"), ('["list"]', "not an object"), (lines[4], "not JSON"), ("null", "not an object")}
    assert {r["file"] for r in kept} == {"part-00000.json"} and {r["aggregation_type"] for r in kept} == {"monthly_aggregation"}


def test_a_target_with_duplicate_keys_is_left_as_it_is(spark, tmp_path):
    import pytest

    from tidemark.operators.merge import DuplicateKeys
    from tidemark.schemas import SECTOR_ROW

    row = '{"emiten":"X","tahun":"2024","triwulan":"TW1","revenue":1}\n'
    (tmp_path / "staged").mkdir()
    (tmp_path / "staged" / "part-00000.json").write_text(row)
    once = spark.read.schema(SECTOR_ROW).json(str(tmp_path / "staged"))
    once.unionByName(once).write.partitionBy("tahun", "triwulan").parquet(str(tmp_path / "target"))
    before = sorted(spark.read.parquet(str(tmp_path / "target")).inputFiles())
    with pytest.raises(DuplicateKeys, match="X, 2024, TW1"):
        J.load_sector_rows(spark, str(tmp_path / "staged"), str(tmp_path / "target"))
    assert sorted(spark.read.parquet(str(tmp_path / "target")).inputFiles()) == before


def test_merge_does_not_shuffle_a_bucketed_target(spark, sf, tmp_path):
    from tidemark.operators import merge as M
    from tidemark.schemas import SECTOR_KEYS, SECTOR_ROW
    from tidemark.sources.keyed import read_keyed, table_name, write_keyed

    path = str(tmp_path / "keyed")
    rows = S.sector_rows(V.filings(spark, sf))
    write_keyed(rows, path, SECTOR_KEYS, 4)
    spark.sql(f"DROP TABLE {table_name(path)}")  # as in another session
    target = read_keyed(spark, path, SECTOR_ROW, SECTOR_KEYS, 4)
    assert target.count() == rows.count()
    batch = spark.createDataFrame(rows.limit(50).collect(), SECTOR_ROW)
    plan = M.set_upsert(target, batch, SECTOR_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    side = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in side[:side.index("FileScan")].split("+- Sort")[0]


def test_tick_store_reads_the_month_only(spark, sf, tmp_path):
    from tidemark.sources import ticks as T

    T.append_ticks(V.ticks(spark, sf), str(tmp_path / "ticks"))
    got = T.month_to_date_ticks(spark, str(tmp_path / "ticks"), date(1998, 8, 20))
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "tick_year" in filters[:120] and "tick_month" in filters[:200] and "GreaterThanOrEqual(day" in plan
    want = V.ticks(spark, sf).filter("Date >= '1998-08-01' AND Date < '1998-08-20'").count()
    assert got.count() == want > 0


def test_a_sorted_sink_runs_its_input_once(spark, tmp_path):
    from tidemark.sinks import writers as W

    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = spark.range(1000).selectExpr("CAST(id * 7 % 1000 AS STRING) AS emiten").repartition(4).mapInArrow(seen, "emiten string")
    W.write_json_sorted(rows, str(tmp_path / "json"))
    assert runs.value == 1000 and spark.read.json(str(tmp_path / "json")).count() == 1000
    W.write_collection(rows, str(tmp_path / "collection"))
    assert runs.value == 2000 and spark.read.parquet(str(tmp_path / "collection")).count() == 1000


def test_appended_rows_are_not_stored_before(spark, tmp_path):
    folder = tmp_path / "staged" / "daily_aggregation"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"Date":"1997-01-02","ticker":"A","avg_close":1.5}\nnot json\n{"Date":"1997-01-03","ticker":"A","avg_close":"x"}\n')
    scratch = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(scratch.glob("tidemark-parsed-*"))
    seen = J.load_prices(spark, str(tmp_path / "staged"), {"daily": str(tmp_path / "daily")}, rejects_path=str(tmp_path / "rejects"))
    assert seen["daily"] == {"appended": 2, "rejected": 1, "mistyped": 1}
    assert set(scratch.glob("tidemark-parsed-*")) == before
    stored = {r["Date"]: r for r in spark.read.parquet(str(tmp_path / "daily")).collect()}
    assert set(stored) == {"1997-01-02", "1997-01-03"} and all(r["load_timestamp"] and r["aggregation_type"] == "daily_aggregation" for r in stored.values())
    assert [r["line"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["not json"]
