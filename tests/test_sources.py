"""File sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import MONTHLY_AGG
from tidemark.sinks import writers as W
from tidemark.sources import staged as ST
from tidemark.sources.ticks import frame_to_ticks


def test_ticker_csv_variants(spark, tmp_path):
    p = tmp_path / "t1"
    p.mkdir()
    (p / "emiten.csv").write_bytes("﻿emiten\nAALI\n\n  ABBA \n   \nABDA,extra".encode("utf-8"))
    assert [r.ticker for r in ST.read_ticker_csv(spark, str(p)).collect()] == ["AALI", "ABBA", "ABDA"]
    q = tmp_path / "t2"
    q.mkdir()
    (q / "emiten.csv").write_text("emiten\n")
    assert ST.read_ticker_csv(spark, str(q)).count() == 0


def test_ticker_lines_keep_commas(spark, tmp_path):
    p = tmp_path / "lines"
    p.mkdir()
    (p / "list.txt").write_text("header\nA,B\n\n C \n")
    assert [r.ticker for r in ST.read_ticker_lines(spark, str(p)).collect()] == ["A,B", "C"]


def test_staged_json_strict_and_lenient(spark, tmp_path):
    d = tmp_path / "monthly"
    d.mkdir()
    good = {"Year": 2024, "Month": 1, "ticker": "A", "avg_open": 1.5}
    (d / "part-00000.json").write_text(json.dumps(good) + "\n\n" + '{"Year": ' + "\n" + json.dumps(good) + "\n")
    (d / "other.json").write_text(json.dumps(good) + "\n")  # not a part file: ignored
    lenient = ST.read_staged_json(spark, str(d), MONTHLY_AGG, strict=False)
    assert lenient.count() == 2
    with pytest.raises(Exception):
        ST.read_staged_json(spark, str(d), MONTHLY_AGG, strict=True).collect()
    assert ST.count_malformed(spark, str(d), MONTHLY_AGG).first().malformed == 1


def test_aggregate_folders_skip_missing(spark, tmp_path):
    base = tmp_path / "data"
    df = spark.createDataFrame([(2024, 1, "A", 2.0)], "Year int, Month int, ticker string, avg_open double")
    W.write_json(df, str(base / "monthly_aggregation"))
    out = ST.read_aggregate_folders(spark, str(base), {"monthly_aggregation": MONTHLY_AGG,
                                                       "yearly_aggregation": MONTHLY_AGG})
    r = out.first()
    assert out.count() == 1 and r.aggregation_type == "monthly_aggregation" and r.load_timestamp is not None


def test_staged_parquet_missing_and_guard(spark, tmp_path):
    assert ST.read_staged_parquet(spark, str(tmp_path / "nope")) is None
    empty = spark.range(0)
    assert W.guard_empty(empty) is False
    with pytest.raises(W.EmptyInput):
        W.guard_empty(empty, on_empty="fail")
    assert W.guard_empty(spark.range(1)) is True


def test_json_sorted_single_file_and_observed_count(spark, tmp_path):
    df = spark.createDataFrame([("B",), ("A",), (None,), ("C",)], "emiten string").repartition(3)
    obs_df, obs = W.counted(df)
    W.write_json_sorted(obs_df, str(tmp_path / "out"), single_file=True)
    files = sorted((tmp_path / "out").glob("part-*.json"))
    lines = [json.loads(x) for x in files[0].read_text().splitlines()]
    assert len(files) == 1 and [x.get("emiten") for x in lines] == [None, "A", "B", "C"]
    assert obs.get["rows"] == 4


def test_frame_to_ticks_defaults(spark):
    frame = spark.createDataFrame(
        [("2024-01-02T00:00:00", "1.5", "nan", "", "None", "-1.9", "A")],
        "index string, Open string, High string, Low string, Close string, Volume string, ticker string")
    t = frame_to_ticks(frame).first()
    assert (t.Open, t.High, t.Low, t.Close, t.Volume, t.Dividends, t["Stock Splits"]) == (1.5, 0.0, 0.0, 0.0, -1, 0.0, 0.0)
    assert len(t["_id"]) == 24 and t.fetch_timestamp is not None
    with pytest.raises(ValueError):
        frame_to_ticks(frame.drop("Close"))


def test_documents_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("A", "2024", "TW1", 1)], "ticker string, tahun string, triwulan string, v int")
    W.write_documents(df, str(tmp_path / "docs"))
    assert (tmp_path / "docs" / "tahun=2024" / "triwulan=TW1" / "ticker=A").is_dir()


def test_manifest(spark):
    from tidemark.sources.manifest import filing_manifest

    keys = spark.createDataFrame([("BBRI", "2024", "TW2")], "ticker string, tahun string, triwulan string")
    r = filing_manifest(keys, "https://example.invalid/r").first()
    assert r.url == "https://example.invalid/r/Laporan%20Keuangan%20Tahun%202024/TW2/BBRI/instance.zip"
    assert r.symbol == "BBRI.JK" and r.document_name == "BBRI_2024_TW2.json"
    assert F is not None


def test_missing_ticker_list_raises(spark, tmp_path):
    # Documented difference: the original returned an empty list.
    with pytest.raises(Exception):
        ST.read_ticker_csv(spark, str(tmp_path / "nope")).collect()


def test_compressed_staging_folders_are_read(spark, tmp_path):
    from tidemark.schemas import YEARLY_AGG
    from tidemark.sinks.writers import write_json
    from tidemark.sources.staged import read_aggregate_folders

    rows = spark.createDataFrame([(1997, f"T{i}", float(i)) for i in range(50)], "Year int, ticker string, avg_close double")
    write_json(rows, str(tmp_path / "yearly_aggregation"), compression="gzip")
    assert list(tmp_path.glob("yearly_aggregation/part-*.json.gz")) and not list(tmp_path.glob("yearly_aggregation/part-*.json"))
    back = read_aggregate_folders(spark, str(tmp_path), {"yearly_aggregation": YEARLY_AGG})
    assert back.select("Year", "ticker", "avg_close").exceptAll(rows).count() == 0 and back.count() == 50


def test_documents_folders_are_listed_by_pattern(spark, tmp_path):
    from tidemark.sinks.writers import read_documents, write_documents

    rows = [(f"T{i}", "1997", f"TW{i % 4 + 1}", i) for i in range(9)]
    kind = "ticker string, tahun string, triwulan string, n int"
    docs = spark.createDataFrame([*rows, (None, "1997", "TW1", 9)], kind)
    write_documents(docs, str(tmp_path / "docs"))
    back = read_documents(spark, str(tmp_path / "docs"), docs.schema)
    assert sorted(back.select(docs.columns).collect(), key=str) == sorted(docs.collect(), key=str)
    assert "InMemoryFileIndex(10 paths)" in back._jdf.queryExecution().executedPlan().toString()
    write_documents(docs.limit(0), str(tmp_path / "none"))
    assert read_documents(spark, str(tmp_path / "none"), docs.schema).count() == 0


def test_whole_filings_can_be_written_smaller(spark, tmp_path):
    from tidemark.sinks.writers import write_parquet

    rows = spark.createDataFrame([(1997, "TW1")], "tahun int, triwulan string")
    write_parquet(rows, str(tmp_path / "out"), partition_by=["tahun"], compression="zstd")
    assert list(tmp_path.glob("out/tahun=1997/*.zstd.parquet")) and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_documents_are_written_and_read_in_the_tasks(spark, tmp_path):
    from tidemark.sinks.writers import read_documents, write_documents

    kind = "ticker string, tahun int, triwulan string, facts map<string,struct<value:string>>, n int"
    names = [f"T{i}" for i in range(60)] + [None, "", "a/b c=%[é]'\"", "a:b*?"]
    rows = [(x, 1997, f"TW{i % 4 + 1}", {"k": ("v\n\"é\"",)} if i % 3 else None, i) for i, x in enumerate(names)]
    docs = spark.createDataFrame([*rows, ("T1", 1997, "TW2", None, 99)], kind)
    ours, sparks = str(tmp_path / "ours"), str(tmp_path / "sparks")
    write_documents(docs.limit(3), ours)  # is overwritten
    write_documents(docs, ours)
    docs.repartition(4, "tahun", "triwulan", "ticker").write.partitionBy("tahun", "triwulan", "ticker").json(sparks)

    def files(top):
        return {(str(f.parent.relative_to(top)), *sorted(f.read_text().splitlines())) for f in tmp_path.joinpath(top).rglob("part-*.json")}

    assert files(tmp_path / "ours") == files(tmp_path / "sparks") and (tmp_path / "ours" / "_SUCCESS").exists()
    # A file that Hadoop writes has a checksum beside it, and each of the two starts a process.
    assert not list((tmp_path / "ours").rglob(".part-*"))
    back = read_documents(spark, ours, docs.schema, file="file")
    assert "FileIndex" not in back._jdf.queryExecution().executedPlan().toString()
    other = spark.read.schema(docs.schema).option("basePath", ours).json(f"{ours}/*/*/*").select("*", F.col("_metadata.file_path").alias("file"))
    assert back.dtypes == other.dtypes and sorted(map(str, back.collect())) == sorted(map(str, other.collect()))
    with pytest.raises(Exception, match="(?i)overwrit"):
        write_documents(spark.read.schema(docs.schema).json(ours), ours)
    assert read_documents(spark, ours, docs.schema).count() == 65
