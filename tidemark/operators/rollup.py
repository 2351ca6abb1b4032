"""Price roll-ups: daily, monthly and yearly averages per ticker (A1-A4).

Averages are of raw ticks, never of daily averages: the exact sum of the doubles,
rounded once, over their count (`functions.exact`), so every result is the same to
the last bit whatever the partitioning.

A sum state is several times the size of the number it begins with, and a ticker has few ticks
a day, so what is shuffled is the ticks' keys and measures, dealt out by month and ticker
(`dealt_by_month`): a hot ticker is spread over its months. Days and months are
summed up where their ticks lie; years are merged from the months' states.

All three grains can come from one scan and that one shuffle. `operators.partials`
stores the days' states between runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exact import merge_states, sum_state, with_sums
from tidemark.functions.periods import iso_to_date, month_of, year_of
from tidemark.schemas import DAILY_KEYS, MEASURES, MONTHLY_KEYS, YEARLY_KEYS


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def with_periods(ticks: DataFrame) -> DataFrame:
    """Typed `Date` plus `Year` and `Month`."""
    d = iso_to_date(_q("Date")) if dict(ticks.dtypes)["Date"] == "string" else _q("Date").cast("date")
    return (
        ticks.withColumn("Date", d)
        .withColumn("Year", year_of("Date"))
        .withColumn("Month", month_of("Date"))
    )


#: The state column of each measure.
STATES = {f"s{i}": out for i, (_, out) in enumerate(MEASURES)}


def _states() -> list[Column]:
    return [sum_state(src).alias(s) for s, (src, _) in zip(STATES, MEASURES, strict=True)]


def averages(states: DataFrame) -> DataFrame:
    """The averages in place of the state columns."""
    return with_sums(states, STATES, averages=True)


def average_by(ticks: DataFrame, keys: list[str]) -> DataFrame:
    """A1-A4 for any key list; `ticks` must already carry the key columns."""
    return averages(ticks.groupBy(*[_q(k) for k in keys]).agg(*_states()))


def dealt_by_month(ticks: DataFrame, slices: int = 0) -> DataFrame:
    """The ticks' keys and measures only, those of a month and ticker in one partition.

    With `slices`, a month's tickers lie in that many partitions at most (`_slice`), so that a
    writer of months makes few files.
    """
    t = with_periods(ticks).select("Date", "Year", "Month", "ticker", *[_q(src) for src, _ in MEASURES])
    if not slices:
        return t.repartition(*MONTHLY_KEYS)
    return t.withColumn("_slice", F.pmod(F.xxhash64("ticker"), F.lit(slices))).repartition("Year", "Month", "_slice")


def daily_average(ticks: DataFrame) -> DataFrame:
    """A1: by (Date, ticker)."""
    return averages(daily_partials(ticks)).drop("Year", "Month")


def monthly_average(ticks: DataFrame) -> DataFrame:
    """A2: by (Year, Month, ticker)."""
    return average_by(dealt_by_month(ticks), MONTHLY_KEYS)


def yearly_average(ticks: DataFrame) -> DataFrame:
    """A3: by (Year, ticker)."""
    return averages(_years(_months(dealt_by_month(ticks))))


def daily_partials(ticks: DataFrame, slices: int = 0) -> DataFrame:
    """One row per (Date, ticker): the sum state of every measure; `slices` as in `dealt_by_month`."""
    return _days(dealt_by_month(ticks, slices), ["_slice"] * (slices > 0)).drop("_slice")


def _days(dealt: DataFrame, also: list[str] = ()) -> DataFrame:
    return dealt.groupBy("Date", "Year", "Month", "ticker", *also).agg(*_states())


def _months(dealt: DataFrame) -> DataFrame:
    return dealt.groupBy(*MONTHLY_KEYS).agg(*_states())


def _years(months: DataFrame) -> DataFrame:
    return months.groupBy(*YEARLY_KEYS).agg(*[merge_states(s).alias(s) for s in STATES])


def all_grains(ticks: DataFrame) -> DataFrame:
    """A1-A3 from one scan of the ticks, as one long table.

    Columns: `grain` ('daily' | 'monthly' | 'yearly'), `Date`, `Year`,
    `Month`, `ticker`, then the seven averages. Keys that do not belong to a
    grain are NULL. The ticks are read and shuffled once: days and months are summed
    up where that shuffle leaves them, years are merged from the months' sums.
    """
    states = list(STATES)
    dealt = dealt_by_month(ticks)
    day = _days(dealt)
    month = day.groupBy(*MONTHLY_KEYS).agg(*[merge_states(s).alias(s) for s in states])  # a month's days lie together
    year = _years(month)
    none = F.lit(None)
    daily = averages(day.select(F.lit("daily").alias("grain"), "Date", none.cast("int").alias("Year"), none.cast("int").alias("Month"), "ticker", *states))
    monthly = averages(month.select(F.lit("monthly").alias("grain"), none.cast("date").alias("Date"), "Year", "Month", "ticker", *states))
    yearly = averages(year.select(F.lit("yearly").alias("grain"), none.cast("date").alias("Date"), "Year", none.cast("int").alias("Month"), "ticker", *states))
    return daily.unionByName(monthly).unionByName(yearly)


def latest_fetch_only(ticks: DataFrame) -> DataFrame:
    """Q9 option: keep one tick per (Date, ticker), the latest fetch.

    The order values alone are reduced per key (a hash aggregate of small
    fields, combined map-side), and the ticks that hold them are found by a
    join, so wide rows are never sorted. Ticks whose date does not parse have
    no day to be the latest of, and are kept as they are; ticks that agree in
    key, fetch time and id are one.
    """
    cols = ticks.columns
    day = iso_to_date(_q("Date")) if dict(ticks.dtypes)["Date"] == "string" else _q("Date")
    order = F.concat_ws("\x1f", F.coalesce(_q("fetch_timestamp").cast("string"), F.lit("")), *[F.coalesce(_q("_id").cast("string"), F.lit(""))] * ("_id" in cols))
    t = ticks.withColumn("_day", day).withColumn("_order", order)
    dated = t.filter(F.col("_day").isNotNull())
    last = dated.groupBy(F.col("_day").alias("_d"), F.col("ticker").alias("_t")).agg(F.max("_order").alias("_last"))
    kept = dated.join(last, (F.col("_day") == F.col("_d")) & F.col("ticker").eqNullSafe(F.col("_t")) & (F.col("_order") == F.col("_last")), "left_semi")
    one = kept.dropDuplicates(["_day", "ticker", "_order"])
    return one.unionByName(t.filter(F.col("_day").isNull())).select(*[_q(c) for c in cols])
