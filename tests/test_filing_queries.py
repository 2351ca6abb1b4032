"""Queries over filings of tables made here: what they store, and how often filings are made."""

from datetime import datetime

import pytest

from tidemark.plans import catalog as C
from tidemark.plans import views as V

SEGMENTS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD", None]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("tables")
    customers = [(i, f"Customer#{i} & <Co>", SEGMENTS[i % 6], i % 25, i - 50.5) for i in range(1, 121)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string, c_nationkey long, c_acctbal double").write.parquet(f"{top}/customer.parquet")
    orders = [(i, i % 130 or None, "FOP"[i % 3], 1000.25 * (i % 7 + 1) if i % 19 else None, datetime(1995 + i % 3, i % 12 + 1, 3), ["1-URGENT", "5-LOW", "2-HIGH"][i % 3]) for i in range(1, 700)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{top}/orders.parquet")
    return str(top)


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    import tidemark.session

    monkeypatch.setattr(tidemark.session, "scratch_path", lambda spark, label: str(tmp_path / label))
    return tmp_path


def test_counted_writes_makes_the_filings_once(spark, tables, scratch, monkeypatch):
    from tidemark.sinks import writers as W

    plans, write = [], W.write_parquet
    monkeypatch.setattr(W, "write_parquet", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().toString()), write(df, *a, **k)))
    out = C.counted_writes(spark, tables)
    plans.append(out._jdf.queryExecution().toString())
    assert ["orders.parquet" in p for p in plans] == [True, *[False] * 6]
    rows = {r.sector: (r.counted, r.stored, r.written) for r in out.collect()}
    filings = V.filings(spark, tables).select(C.S.fact(C.S.SECTOR_KEY).alias("sector")).collect()
    for sector in C.S.SECTORS:
        n = sum(f.sector is not None and (f.sector == sector if sector != C.S.OTHER else f.sector not in C.S.SPECIAL_SECTORS) for f in filings)
        assert n and rows[sector] == (n, n, True)
    assert rows["nobody's"] == (0, 0, False) and len(rows) == 6


def test_filing_documents_are_stored_compressed(spark, tables, scratch):
    rows = C.filing_documents(spark, tables).collect()
    files = [f.name for f in (scratch / "filings").glob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    facts = {(r.ticker, r.tahun, r.triwulan): len(r.facts) for r in V.filings(spark, tables).withColumn("kind", V.archive_kind()).filter("kind < 2").collect()}
    assert {(r.ticker, r.tahun, r.triwulan): r.n_facts for r in rows} == facts and len(rows) == len(facts) > 0


def test_filings_are_made_in_compiled_methods(spark, tables):
    for revised in (False, True):
        made = V.filings(spark, tables, revised=revised)
        line = next(x for x in made._jdf.queryExecution().executedPlan().toString().splitlines() if "map_from_entries(" in x)
        # Not a lambda over the facts, and not in whole-stage code either, where Spark would not split the methods.
        assert "map_from_entries(concat(" in line and "*(" not in line.split("Project")[0]
        flat = {(r.ticker, r.tahun, r.triwulan): {k: v for k, v in r.asDict().items() if k not in ("ticker", "tahun", "triwulan") and v is not None} for r in V.filing_fact_columns(spark, tables, revised=revised).collect()}
        facts = {(r.ticker, r.tahun, r.triwulan): r.facts for r in made.collect()}
        assert {k: {x: f.value for x, f in v.items()} for k, v in facts.items()} == flat and facts
        assert all((f.name, f.context) == V.split_key(k) for v in facts.values() for k, f in v.items())


def test_archives_are_as_zipfile_writes_them(monkeypatch):
    import io
    import time
    import zipfile

    monkeypatch.setattr(time, "time", lambda: 1_000_000_000.0)
    pack = V.zip_writer()
    for name, data in (("instance.xbrl", "<r>é</r>".encode() * 999), ("Report/Instance.XBRL", b""), ("readme.txt", bytes(range(256)) * 40)):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("Report/", b"")
            zf.writestr("Taxonomy.xsd", b"<schema/>")
            zf.writestr(name, data)
        assert pack(name, data) == buf.getvalue()
        assert zipfile.ZipFile(io.BytesIO(pack(name, data))).read(name) == data
