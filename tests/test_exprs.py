"""Column builders: null-aware sums, guarded differences, safe conversions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X


def _one(spark, expr, **cols):
    names = list(cols)
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], schema)
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "a,b,c,expected",
    [
        (None, None, None, None),
        ("7", None, None, Decimal("7")),
        ("7", "1.5", None, Decimal("8.5")),
        ("7", "", None, None),  # a present blank makes the sum NULL
        ("1000000000000", "1", "0.25", Decimal("1000000000001.25")),
        ("x", None, None, None),
    ],
)
def test_sum_if_any(spark, a, b, c, expected):
    r = _one(spark, X.sum_if_any("a", "b", "c"), a=a, b=b, c=c)
    assert (r is None and expected is None) or r == expected


@pytest.mark.parametrize(
    "a,b,expected",
    [("10", "3", Decimal("7")), ("10", None, None), (None, "3", None), ("", "3", None), ("2.5", "0.5", Decimal("2"))],
)
def test_guarded_difference(spark, a, b, expected):
    r = _one(spark, X.guarded_difference("a", "b"), a=a, b=b)
    assert (r is None and expected is None) or r == expected


@pytest.mark.parametrize(
    "i1,i2,e,expected",
    [(None, None, "5", None), ("10", None, None, None), ("10", None, "4", Decimal("6")),
     ("10", "1", "4", Decimal("7")), ("10", "", "4", None)],
)
def test_sum_minus_required(spark, i1, i2, e, expected):
    r = _one(spark, X.sum_minus_required(["i1", "i2"], "e"), i1=i1, i2=i2, e=e)
    assert (r is None and expected is None) or r == expected


@pytest.mark.parametrize(
    "b,d1,d2,expected",
    [("100", None, None, None), (None, "5", None, None), ("100", "5", None, Decimal("95")),
     ("100", "5", "10", Decimal("85")), ("100", "", "10", None)],
)
def test_required_minus_optional(spark, b, d1, d2, expected):
    r = _one(spark, X.required_minus_optional("b", ["d1", "d2"]), b=b, d1=d1, d2=d2)
    assert (r is None and expected is None) or r == expected


@pytest.mark.parametrize(
    "a,b,c,expected",
    [(None, "2", "3", Decimal("2")), ("", "2", "3", None), (None, None, None, None), ("1", "2", None, Decimal("1"))],
)
def test_first_present(spark, a, b, c, expected):
    r = _one(spark, X.first_present("a", "b", "c"), a=a, b=b, c=c)
    assert (r is None and expected is None) or r == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("1.9", 1.9), ("-1.9", -1.9), ("nan", 0.0), ("NaN", 0.0), (None, 0.0), ("", 0.0), ("x", 0.0),
     ("1e3", 1000.0), ("None", 0.0), ("none", 0.0)],
)
def test_safe_float(spark, raw, expected):
    assert _one(spark, X.safe_float("v"), v=raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("1.9", 1), ("-1.9", -1), ("1e3", 1000), ("nan", 0), (None, 0), ("", 0), ("x", 0), ("42", 42)],
)
def test_safe_int(spark, raw, expected):
    assert _one(spark, X.safe_int("v"), v=raw) == expected


def test_safe_float_on_doubles(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.5,)], "v double")
    assert [r[0] for r in df.select(X.safe_float("v")).collect()] == [0.0, 0.0, 2.5]


def test_default_column_and_order(spark):
    df = spark.createDataFrame([("A", None)], "ticker string, Dividends double")
    out = X.with_default_column(X.with_default_column(df, "Dividends"), "Stock Splits")
    assert out.first().asDict() == {"ticker": "A", "Dividends": 0.0, "Stock Splits": 0.0}
    ordered = X.canonical_order(out, ["Stock Splits", "missing", "ticker"])
    assert ordered.columns == ["Stock Splits", "ticker", "Dividends"]


def test_surrogate_id_shape(spark):
    r = spark.range(3).select(X.surrogate_id().alias("i")).collect()
    assert all(len(x.i) == 24 and int(x.i, 16) >= 0 for x in r)
    assert len({x.i for x in r}) == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_modes_agree(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("7", "", "1.5", "x")], "a string, b string, c string, d string")
        r = df.select(
            X.sum_if_any("a", "c").alias("s"), X.sum_if_any("a", "b").alias("blank"),
            X.guarded_difference("a", "d").alias("bad"), X.safe_int("d").alias("si"),
            X.safe_float("b").alias("sf"), F.col("a").try_cast("date").alias("dt"),
        ).first()
        assert r.s == Decimal("8.5") and r.blank is None and r.bad is None and r.si == 0 and r.sf == 0.0
        assert r.dt is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
