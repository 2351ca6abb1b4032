"""Exact, mergeable sums of doubles in built-in expressions (A1-A4).

A plain sum of doubles depends on the order in which rows and partial sums meet.
Here every value is cut into three whole numbers, its limbs: the part before the
point, and two times `BITS` bits behind it. Limbs are summed as longs, so a sum is the same
whatever the partitioning, and two sums add up by adding their limbs: a state can be
stored and merged with later ones.

What is exact: all bits of values from 2^-20 (about 10^-6) up to `TOP`. Of smaller
values the bits below 2^-72 are cut off, the same way in every order. Values of `TOP` or
more, infinities and NaN go to a plain double beside the limbs (`wide`), and a sum that
has any is theirs, beside which the others vanish or nearly so. A sum becomes
a double by correct rounding, to the nearest, ties to even. A group may hold 2^26
values before its first merge; merging carries the limbs over, so merged groups have no
such bound.

State: struct(l0, l1, l2 long, wide double, n long). NULL values are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

BITS = 36
TOP = 2.0 ** BITS
_MASK = (1 << BITS) - 1
_UNIT = 2.0 ** -BITS
LIMB_NAMES = ["l0", "l1", "l2"]
STATE = StructType([StructField(c, LongType()) for c in LIMB_NAMES] + [StructField("wide", DoubleType()), StructField("n", LongType())])


def sum_state(column: str) -> Column:
    """Aggregate: the state of all values of a group, of a column of any numeric type."""
    x = f"CAST(`{column}` AS DOUBLE)"
    narrow = f"CASE WHEN abs({x}) < {TOP!r}D THEN {x} END"  # NaN is greater than any number
    limbs = (f"CAST(({narrow} % {_UNIT!r}D) / {_UNIT ** 2!r}D AS BIGINT)", f"CAST(({narrow} % 1D) / {_UNIT!r}D AS BIGINT)", f"CAST({narrow} AS BIGINT)")
    sums = ", ".join(f"'{c}', coalesce(sum({x}), 0L)" for c, x in zip(LIMB_NAMES, limbs))
    return F.expr(f"named_struct({sums}, 'wide', sum(CASE WHEN abs({x}) >= {TOP!r}D THEN {x} END), 'n', count({x}))")


def merge_states(state: str) -> Column:
    """Aggregate: one state of many; each limb first hands what passes its bits on to the next."""
    own = [f"`{state}`.{c} & {_MASK}L" for c in LIMB_NAMES[:2]] + [f"`{state}`.l2"]
    carry = [""] + [f" + shiftright(`{state}`.{c}, {BITS})" for c in LIMB_NAMES[:2]]
    sums = ", ".join(f"'{c}', coalesce(sum(({x}){y}), 0L)" for c, x, y in zip(LIMB_NAMES, own, carry))
    return F.expr(f"named_struct({sums}, 'wide', sum(`{state}`.wide), 'n', sum(`{state}`.n))")


#: The common case of rounding: whole units of 2^-16, and 53 bits of fraction below.
_STEP = 2.0 ** -53


def _window(d: list[str]) -> tuple[str, str]:
    """SQL of the sum's whole units of 2^-16 and of the 53 bits below, both doubles without loss where the sum is below 2^37."""
    whole = f"CAST({d[2]} * 65536L + shiftright({d[1]}, 20) AS DOUBLE)"
    bits = f"shiftleft({d[1]} & {(1 << 20) - 1}L, 33) | shiftright({d[0]}, 3)"
    return f"CASE WHEN abs({d[2]}) < {1 << 37}L THEN {whole} END", f"CAST({bits} AS DOUBLE) * {_STEP!r}D"


def _value(d: list[str], whole: str, part: str) -> str:
    """SQL of the double nearest to the number of these digits.

    The sum is whole + part + less than 2^-53. If adding 2^-53 rounds to the same
    double, or nothing is left below, whole + part is the rounded sum. For the
    rest all digits are one decimal that is rounded once, or, where its top digit alone
    has 53 bits or more, the upper two are, the last bit set if the lowest digit is not
    0, which rounds alike. That rare step is a lambda, which keeps it out of the compiled
    projection: methods beyond some size are not compiled at all.
    """
    base = f"CAST({1 << BITS}L AS DECIMAL(11,0))"
    upper = f"(CAST(t[2] AS DECIMAL(19,0)) * {base} + CAST(t[1] AS DECIMAL(19,0)))"
    all_ = f"CAST(CAST({upper} AS DECIMAL(27,0)) * {base} + CAST(t[0] AS DECIMAL(19,0)) AS DOUBLE) * {_UNIT ** 2!r}D"
    sticky = f"CAST(CAST(t[2] AS DECIMAL(19,0)) * {base} + CAST(t[1] | CASE WHEN t[0] != 0 THEN 1L ELSE 0L END AS DECIMAL(19,0)) AS DOUBLE) * {_UNIT!r}D"
    rare = f"transform(array(array({', '.join(d)})), t -> CASE WHEN abs(t[2]) < {1 << 53}L THEN {all_} ELSE {sticky} END)[0]"
    settled = f"{whole} + {part} = {whole} + ({part} + {_STEP!r}D) OR {d[0]} & 7L = 0"
    return f"CASE WHEN {whole} IS NOT NULL AND ({settled}) THEN ({whole} + {part}) * {2.0 ** -16!r}D ELSE {rare} END"


def with_sums(df: DataFrame, states: dict[str, str], averages: bool = False) -> DataFrame:
    """`df` with the sum (or average) of each state column: `states` maps state -> output name.

    Digits, windows and values are projections of their own, so that no expression grows.
    """
    names, plain = list(states), [F.col(f"`{c}`") for c in df.columns]
    d = [[f"_d{i}_{k}" for k in range(3)] for i in range(len(names))]
    digits = []
    for i, s in enumerate(names):
        low = f"`{s}`.l1 + shiftright(`{s}`.l0, {BITS})"
        digits += [F.expr(x).alias(c) for c, x in zip(d[i], (f"`{s}`.l0 & {_MASK}L", f"({low}) & {_MASK}L", f"`{s}`.l2 + shiftright({low}, {BITS})"))]
    windows = [F.expr(x).alias(f"_{c}{i}") for i in range(len(names)) for c, x in zip("wp", _window(d[i]))]
    out = []
    for i, s in enumerate(names):
        total = f"CASE WHEN `{s}`.wide IS NULL THEN {_value(d[i], f'_w{i}', f'_p{i}')} ELSE `{s}`.wide END"
        divided = f"({total}) / `{s}`.n" if averages else total
        out.append(F.expr(f"CASE WHEN `{s}`.n > 0 THEN {divided} END").alias(states[s]))
    spread = df.select(*plain, *digits).select("*", *windows)
    return spread.select(*[F.col(f"`{c}`") for c in df.columns if c not in states], *out)
