"""Averages between runs: the store of daily sums, its refresh, and the file stream over it."""

from pyspark.sql import functions as F

from tidemark.operators import partials as P
from tidemark.operators import rollup as R
from tidemark.plans import views as V
from tidemark.sinks.writers import write_json
from tidemark.streaming import prices as SP


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def drops(spark, sf):
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return V.ticks(spark, sf, cut), V.ticks(spark, sf, ~cut)


def test_runs_add_up_to_the_averages_of_all_ticks(spark, sf, tmp_path):
    src, store, tgt, ck = (str(tmp_path / x) for x in ("ticks", "store", "monthly", "ck"))
    first, second = drops(spark, sf)
    write_json(first, f"{src}/drop=1")
    once = SP.run_incremental(spark, src, store, tgt, ck)
    assert rows(once) == rows(R.monthly_average(first).select(*once.columns))
    write_json(second, f"{src}/drop=2")
    twice = SP.run_incremental(spark, src, store, tgt, ck)
    want = rows(R.monthly_average(V.ticks(spark, sf)).select(*twice.columns))
    assert rows(twice) == want
    assert rows(SP.run_incremental(spark, src, store, tgt, ck)) == want  # no new files


def test_a_repeated_batch_counts_once_and_a_run_touches_its_periods_only(spark, sf, tmp_path):
    store, tgt = str(tmp_path / "store"), str(tmp_path / "yearly")
    first, second = drops(spark, sf)
    P.fold(first, store, 0)
    P.refresh(spark, store, 0, tgt, "yearly")
    before = {f: n for f, n in spark.read.parquet(tgt).select("_metadata.file_name", "Year").distinct().collect()}
    for _ in range(2):  # the second time as after a failure
        P.fold(second, store, 1)
        P.refresh(spark, store, 1, tgt, "yearly")
    got = spark.read.parquet(tgt)
    assert rows(got.select("Year", "ticker", "avg_open")) == rows(R.yearly_average(V.ticks(spark, sf)).select("Year", "ticker", "avg_open"))
    after = {f: n for f, n in got.select("_metadata.file_name", "Year").distinct().collect()}
    years = {r[0] for r in second.select(F.year(F.col("Date").cast("date"))).distinct().collect()}
    assert {f for f in before if before[f] not in years} <= set(after)  # untouched files are the same files
    assert not {f for f in before if before[f] in years} & set(after)


def test_refresh_prunes_the_store(spark, sf, tmp_path):
    store = str(tmp_path / "store")
    P.fold(V.ticks(spark, sf), store, 0)
    P.fold(V.ticks(spark, sf, F.col("l_shipdate") >= F.lit("1998-10-01").cast("timestamp_ntz")), store, 1)
    states = P.read_store(spark, store).filter(P.touched(spark, store, 1, ["Year", "Month"]))
    plan = P.averages_of(states, "monthly")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [("):]
    filters = filters[:filters.index("PushedFilters")]
    assert "Year#" in filters and "Month#" in filters


def test_no_ticks_and_bad_dates(spark, sf, tmp_path):
    store, tgt = str(tmp_path / "store"), str(tmp_path / "monthly")
    bad = V.ticks(spark, sf).limit(20).withColumn("Date", F.when(F.col("Volume") > 20, F.lit("no day")).otherwise(F.col("Date")))
    P.fold(bad, store, 0)
    P.refresh(spark, store, 0, tgt, "monthly")
    got = spark.read.parquet(tgt)
    assert got.count() == R.monthly_average(bad).count()
    P.fold(bad.limit(0), store, 1)
    P.refresh(spark, store, 1, tgt, "monthly")
    assert rows(spark.read.parquet(tgt)) == rows(got)


def test_a_batch_is_shuffled_once_and_a_small_month_is_one_file(spark, sf, tmp_path):
    from tidemark.operators import rollup as R

    plan = R.daily_partials(V.ticks(spark, sf), P.SLICES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    P.fold(V.ticks(spark, sf), str(tmp_path / "store"), 0)
    for month in tmp_path.glob("store/Year=*/Month=*/batch=0"):
        assert len(list(month.glob("*.parquet"))) == 1
