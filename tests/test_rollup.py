"""Price roll-ups."""

import math

from pyspark.sql import functions as F

from tidemark.operators import rollup as R
from tidemark.schemas import TICK


def ticks(spark, rows):
    full = [(None, d, o, o, o, o, v, 0.0, 0.0, t, None) for d, o, v, t in rows]
    return spark.createDataFrame(full, TICK)


def test_average_of_raw_ticks_not_of_daily_averages(spark):
    t = ticks(spark, [("2024-01-02T00:00:00", 10.0, 1, "A"), ("2024-01-02T00:00:00", 20.0, 3, "A"),
                      ("2024-01-03T00:00:00", 40.0, 5, "A")])
    m = R.monthly_average(t).first()
    assert m.avg_open == 70.0 / 3 and m.avg_volume == 3.0  # not (15 + 40) / 2
    d = {r.Date.isoformat(): r.avg_open for r in R.daily_average(t).collect()}
    assert d == {"2024-01-02": 15.0, "2024-01-03": 40.0}


def test_nan_poisons_and_null_skips(spark):
    t = ticks(spark, [("2024-01-02T00:00:00", float("nan"), 1, "A"), ("2024-01-02T00:00:00", 5.0, 1, "A"),
                      ("2024-01-02T00:00:00", None, 1, "B"), ("2024-01-02T00:00:00", 4.0, 1, "B")])
    got = {r.ticker: r.avg_open for r in R.daily_average(t).collect()}
    assert math.isnan(got["A"]) and got["B"] == 4.0


def test_bad_date_groups_as_null(spark):
    t = ticks(spark, [("nope", 1.0, 1, "A"), ("2024-02-01T00:00:00", 3.0, 1, "A")])
    got = {(r.Year, r.Month): r.avg_open for r in R.monthly_average(t).collect()}
    assert got == {(None, None): 1.0, (2024, 2): 3.0}


def test_grouping_sets_equal_three_scans(spark, sf):
    from tidemark.plans import views as V

    t = V.ticks(spark, sf)
    g = R.all_grains(t)
    daily = g.filter("grain = 'daily'").select("Date", "ticker", "avg_open", "avg_close")
    monthly = g.filter("grain = 'monthly'").select("Year", "Month", "ticker", "avg_high", "avg_volume")
    yearly = g.filter("grain = 'yearly'").select("Year", "ticker", "avg_low", "avg_stock_splits")
    d2 = R.daily_average(t).select("Date", "ticker", "avg_open", "avg_close")
    m2 = R.monthly_average(t).select("Year", "Month", "ticker", "avg_high", "avg_volume")
    y2 = R.yearly_average(t).select("Year", "ticker", "avg_low", "avg_stock_splits")
    for a, b in ((daily, d2), (monthly, m2), (yearly, y2)):
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_grouping_sets_scan_once(spark, sf):
    from tidemark.plans import views as V

    qe = R.all_grains(V.ticks(spark, sf))._jdf.queryExecution()
    qe.toRdd().count()  # adaptive execution reuses the shuffle of the daily sums as it runs
    plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_latest_fetch_only(spark):
    rows = [("x1", "2024-01-02T00:00:00", 1.0, "A", "2024-01-02T10:00:00"),
            ("x2", "2024-01-02T00:00:00", 2.0, "A", "2024-01-03T10:00:00"),
            ("x3", "2024-01-03T00:00:00", 3.0, "A", "2024-01-03T10:00:00")]
    full = [(i, d, o, o, o, o, 1, 0.0, 0.0, t, f) for i, d, o, t, f in rows]
    out = R.latest_fetch_only(spark.createDataFrame(full, TICK))
    assert sorted(r["_id"] for r in out.collect()) == ["x2", "x3"]


def test_averages_are_of_the_doubles_as_they_are(spark):
    vals = [0.1234567, 4e-7, 1.23456789012, 1e14]
    t = ticks(spark, [("2024-01-02T00:00:00", v, 1, tk) for v, tk in zip(vals, "ABCD", strict=True)])
    for out in (R.daily_average(t), R.monthly_average(t), R.all_grains(t)):
        assert {r.ticker: r.avg_open for r in out.collect()} == dict(zip("ABCD", vals, strict=True))


def test_unparsable_dates_are_kept_by_latest_fetch(spark):
    full = [(i, d, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, "A", "2024-01-02T10:00:00") for i, d in (("x1", "bad"), ("x2", "worse"), ("x3", None))]
    assert R.latest_fetch_only(spark.createDataFrame(full, TICK)).count() == 3


def test_ansi_modes_agree(spark, sf):
    from tidemark.plans import views as V

    old = spark.conf.get("spark.sql.ansi.enabled")
    out = []
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            out.append(sorted(R.all_grains(V.ticks(spark, sf)).collect(), key=str))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert out[0] == out[1]


def test_ticks_are_shuffled_once_and_not_their_states(spark, sf):
    from tidemark.plans import views as V

    t = V.ticks(spark, sf)
    for df, shuffles in ((R.daily_average(t), 1), (R.monthly_average(t), 1), (R.yearly_average(t), 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == shuffles
        first = plan[plan.rindex("Exchange hashpartitioning"):]
        assert "Aggregate" not in first  # below the first shuffle there are ticks
