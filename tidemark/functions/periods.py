"""Reporting periods and date helpers.

The period rule takes an explicit `as_of` date; the wall clock is only a
default, so reruns of an old period are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_closed_period(as_of: Column | str) -> tuple[Column, Column]:
    """The last reporting quarter that has closed on `as_of`.

    Months 1-3 give (previous year, 4); 4-6 give (year, 1); 7-9 (year, 2);
    10-12 (year, 3). Stepping back three months and reading year and quarter
    of that day gives exactly this rule.
    """
    back = F.add_months(_c(as_of).cast(DateType()), -3)
    return F.year(back).cast(IntegerType()), F.quarter(back).cast(IntegerType())


def latest_closed_period_of(as_of: _dt.date | None = None) -> tuple[str, int]:
    """D1 for one date on the driver (names of targets only, never data)."""
    d = as_of or _dt.date.today()
    if d.month <= 3:
        return str(d.year - 1), 4
    return str(d.year), (d.month - 1) // 3


def _text(*parts: Column | str | int) -> Column | str:
    """The parts one after the other: a column if any of them is one."""
    if any(isinstance(p, Column) for p in parts):
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return "".join(str(p) for p in parts)


def period_suffix(year: str | int | Column, quarter: int | Column) -> str | Column:
    """K8: `{year}TW{quarter}`, the suffix of the per-period targets."""
    return _text(year, "TW", quarter)


def iso_to_date(x: Column | str) -> Column:
    """ISO text -> date; bad text gives NULL under any ANSI setting.

    The date part of 'yyyy-mm-dd', 'yyyy-mm-ddThh:mm:ss' or the same with an
    offset is kept as written (no time-zone shift).
    """
    return _c(x).try_cast(DateType())


def year_of(d: Column | str) -> Column:
    """D3."""
    return F.year(_c(d)).cast(IntegerType())


def month_of(d: Column | str) -> Column:
    """D4."""
    return F.month(_c(d)).cast(IntegerType())


def month_to_date(d: Column | str, as_of: Column | str) -> Column:
    """Predicate for the first of `as_of`'s month up to, not including, `as_of`."""
    d = _c(d)
    as_of = _c(as_of).cast(DateType())
    return (d >= F.trunc(as_of, "MM")) & (d < as_of)


def target_name(prefix: str, year: str | int | Column, quarter: int | Column, suffix: str = "") -> str | Column:
    """K8: per-period target name, `{prefix}{year}TW{quarter}{suffix}`, of one period or of a column of them.

    Prefix and suffix are deployment settings (input and output targets of
    one period differ only by them); inside Spark prefer the partition
    columns `tahun` / `triwulan` over one target per period.
    """
    return _text(prefix, period_suffix(year, quarter), suffix)
