"""Reporting periods and date helpers."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import periods as PD


def rule(d: dt.date):
    if d.month <= 3:
        return d.year - 1, 4
    return d.year, (d.month - 1) // 3


def test_latest_closed_period_every_day(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2025-01-10')) AS d")
    y, q = PD.latest_closed_period(F.col("d"))
    got = {r.d: (r.y, r.q) for r in days.select("d", y.alias("y"), q.alias("q")).collect()}
    assert len(got) == 383
    assert all(got[d] == rule(d) for d in got)
    assert all(PD.latest_closed_period_of(d) == (str(rule(d)[0]), rule(d)[1]) for d in got)


def test_period_suffix():
    assert PD.period_suffix("2024", 3) == "2024TW3"


def test_iso_to_date_variants(spark):
    df = spark.createDataFrame(
        [("2025-05-27",), ("2025-05-27T00:00:00",), ("2025-05-27T00:00:00+07:00",), ("nope",), (None,)], "s string")
    got = [r[0] for r in df.select(PD.iso_to_date("s")).collect()]
    assert got[:3] == [dt.date(2025, 5, 27)] * 3 and got[3:] == [None, None]


def test_month_to_date(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2025-04-28', DATE'2025-05-22')) AS d")
    got = [r.d for r in df.filter(PD.month_to_date(F.col("d"), F.lit("2025-05-20"))).collect()]
    assert got[0] == dt.date(2025, 5, 1) and got[-1] == dt.date(2025, 5, 19) and len(got) == 19


def test_target_name():
    assert PD.target_name("filings_", "2024", 2, "_final") == "filings_2024TW2_final"
