"""Column builders for null-aware measures and safe conversions.

All of these return plain `Column` expressions: they run inside whole-stage
codegen, never in Python. Each one gives the same answer with
`spark.sql.ansi.enabled` on or off, because every conversion from text is a
`try_cast` and no expression leans on implicit coercion.

Facts arrive as text. Presence is tested on the raw text and the cast happens
inside the helper, so a blank fact `""` stays "present but not a number"
(it turns a sum into NULL) instead of turning into "absent".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType

from tidemark.schemas import FACT_NUMBER, MONEY


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: The white space that text is stripped of.
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# What a text number looks like; a cast alone would also take the suffixes f and d.
_NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
_INFINITE = r"^[+-]?(inf|infinity)$"


def strip(x: Column | str) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(_c(x), F.lit(WHITE_SPACE))


def to_double(x: Column | str) -> Column:
    """Text -> double where the text is a number and nothing else; other types are cast."""
    x = _c(x)
    t = strip(x.cast(StringType()))
    number = F.when(t.rlike(_NUMBER), F.replace(t, F.lit("_"))).when(F.lower(t).rlike(_INFINITE), F.replace(F.lower(t), F.lit("infinity"), F.lit("inf")))
    return number.try_cast(DoubleType())


def num(x: Column | str, dtype: DataType = FACT_NUMBER) -> Column:
    """Text fact -> exact number; NULL when absent, blank or not a number."""
    return _c(x).try_cast(dtype)


def not_a_number(x: Column | str) -> Column:
    """A fact that is there, is not blank, and still does not become a number (text, or beyond the range)."""
    return ~is_blank(x) & num(x).isNull()


def part(x: Column | str) -> Column:
    """One term of a null-aware sum: absent counts as 0, present is parsed."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(0).cast(FACT_NUMBER)).otherwise(num(x))


def any_present(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).isNotNull() for c in cols])


def sum_if_any(*cols: Column | str) -> Column:
    """NULL when every input is absent, else the sum with absent as 0.

    A present value that does not parse (e.g. a blank) makes the sum NULL.
    """
    total = reduce(lambda a, b: a + b, [part(c) for c in cols])
    return F.when(any_present(*cols), total).cast(MONEY)


def guarded_difference(a: Column | str, b: Column | str) -> Column:
    """`a - b` only when both are present (NULL propagates through num)."""
    return (num(a) - num(b)).cast(MONEY)


def sum_minus_required(incomes: list[Column | str], expense: Column | str) -> Column:
    """P5: at least one income present and the expense present."""
    return (sum_if_any(*incomes) - num(expense)).cast(MONEY)


def required_minus_optional(base: Column | str, deductions: list[Column | str]) -> Column:
    """Base present and at least one deduction present; missing ones are 0."""
    return (num(base) - sum_if_any(*deductions)).cast(MONEY)


def first_present(*cols: Column | str) -> Column:
    """The first non-null raw value, then parsed.

    The coalesce runs on the raw text, so a blank earlier alternative wins
    (and parses to NULL), as in the original rules.
    """
    return num(F.coalesce(*[_c(c) for c in cols])).cast(MONEY)


def money(x: Column | str) -> Column:
    """A single fact as money."""
    return num(x).cast(MONEY)


def safe_float(x: Column | str, default: float = 0.0) -> Column:
    """NULL, NaN, 'nan', 'none', blank or unparseable -> default."""
    return F.coalesce(F.nanvl(to_double(x), F.lit(default)), F.lit(default)).cast(DoubleType())


def safe_int(x: Column | str, default: int = 0) -> Column:
    """Parse through a double, truncate toward zero, default on failure."""
    as_double = to_double(x)
    # NaN and values beyond the long range have no integer: default (`beyond_long` tells them).
    truncated = F.when(F.isnan(as_double), F.lit(None)).otherwise(as_double.try_cast(LongType()))
    return F.coalesce(truncated, F.lit(default).cast(LongType()))


def beyond_long(x: Column | str) -> Column:
    """A number that `safe_int` cannot hold, to be counted or flagged."""
    as_double = to_double(x)
    return F.coalesce(~F.isnan(as_double) & as_double.try_cast(LongType()).isNull(), F.lit(False))


def with_default_column(df, name: str, default: float = 0.0):
    """P10: add an absent optional column, or fill its NULLs, with a default."""
    if name in df.columns:
        return df.withColumn(name, F.coalesce(F.col(f"`{name}`").cast(DoubleType()), F.lit(default)))
    return df.withColumn(name, F.lit(default).cast(DoubleType()))


def surrogate_id() -> Column:
    """24 hex characters of a random UUID."""
    return F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, 24)


def with_load_metadata(df, kind: str):
    """Tag the aggregate kind and the load time."""
    return df.withColumn("aggregation_type", F.lit(kind)).withColumn(
        "load_timestamp", F.current_timestamp()
    )


def canonical_order(df, ordered: list[str]):
    """The named columns first (those present), every other column after."""
    first = [c for c in ordered if c in df.columns]
    rest = [c for c in df.columns if c not in first]
    return df.select(*[F.col(f"`{c}`") for c in first + rest])


def is_blank(x: Column | str) -> Column:
    """NULL or only white space."""
    return F.coalesce(strip(_c(x).cast(StringType())) == F.lit(""), F.lit(True))
