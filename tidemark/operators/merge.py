"""Keyed merges as Spark joins and aggregates.

Plain Parquet has no MERGE INTO, so a merge is a new version of (a slice of) the
target: `replace_upsert` and `set_upsert` return the merged DataFrame and write
nothing. The jobs restrict the target to the partitions that a batch touches.

* In-batch order: the batch is folded to one row per key first, in the
  order of a `seq` column (staged files have one: `sources.staged.ORDER`), or,
  without one, in the order in which Spark reads the rows. A NULL order value is
  an error. "Last write wins" is a `max_by` aggregate, which combines map-side: a
  hot key that holds a third of the batch is reduced inside every task before the
  shuffle. A batch that states each key once by its making need not be folded
  (`unique=True`).
* Key check (M8): `check_target` makes the merge itself fail where a key of the
  target occurs twice, in the pass that writes, before anything is published.
* Each merge is one join of the target with the folded batch; nothing runs while
  the plan is built, and adaptive execution picks the join from real sizes.
* NULL keys: `null_safe=True` matches NULL to NULL (`<=>`), the way a
  document store matches a null filter; grouping always treats NULLs as one
  key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

ACTION = "_action"
_ORDER = "_order"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _others(df: DataFrame, keys: list[str], drop: list[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in drop]


def _ordered(batch: DataFrame, seq: str | None) -> tuple[DataFrame, Column]:
    """The batch and its order column; without `seq` the order of reading."""
    if seq is None:
        return batch.withColumn(_ORDER, F.monotonically_increasing_id()), F.col(_ORDER)
    checked = F.when(_q(seq).isNull(), F.raise_error(F.lit(f"{seq} is NULL: the order of the batch is not known"))).otherwise(_q(seq))
    return batch, checked


def last_write_wins(batch: DataFrame, keys: list[str], seq: str | None = "seq", keep_seq: bool = False) -> DataFrame:
    """M5 (replace): one row per key, the row with the greatest `seq`."""
    rest = _others(batch, keys, [] if keep_seq else [seq])
    ordered, order = _ordered(batch, seq)
    payload = F.struct(*[_q(c) for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    out = ordered.groupBy(*[_q(k) for k in keys]).agg(F.max_by(payload, order).alias("_row"))
    return out.select(*[_q(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest])


def set_fold(batch: DataFrame, keys: list[str], seq: str | None = "seq") -> DataFrame:
    """M5 ($set): per key and per column, the latest non-NULL value.

    A later row's NULL (an absent field) does not erase an earlier value.
    """
    rest = _others(batch, keys, [seq])
    ordered, order = _ordered(batch, seq)
    if not rest:
        return ordered.select(*[_q(k) for k in keys]).distinct()
    return ordered.groupBy(*[_q(k) for k in keys]).agg(
        *[F.max_by(_q(c), F.when(_q(c).isNotNull(), order)).alias(c) for c in rest]
    )


def required_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """F8: drop records that lack any key field."""
    return df.na.drop(how="any", subset=keys)


def _key_match(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    """Join condition between two aliased sides, by alias (lineage-safe)."""
    conds = []
    for k in keys:
        a, b = F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")
        conds.append(a.eqNullSafe(b) if null_safe else a == b)
    return reduce(lambda a, b: a & b, conds)


class DuplicateKeys(RuntimeError):
    """A load was refused because a key of its target, or of a batch said to be unique, occurs more than once."""


REFUSAL = "duplicate key: "


def one_row_per_key(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """M8 as a gate: the rows as they are; reading a row whose key occurs again is an error.

    The rows of a key meet where the merge's join needs them anyway (same keys, same
    order), so the check adds no shuffle or sort to it.
    """
    named = F.concat_ws(", ", *[F.coalesce(_q(k).cast("string"), F.lit("NULL")) for k in keys])
    fault = F.raise_error(F.concat(F.lit(f"{REFUSAL}{what} has more than one row of "), named))
    rows = df.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*[_q(k) for k in keys])))
    return rows.filter(F.when(F.col("_rows") > 1, fault.cast("boolean")).otherwise(F.lit(True))).drop("_rows")


def merge(target: DataFrame, incoming: DataFrame, keys: list[str], mode: str = "replace", seq: str | None = None,
          null_safe: bool = False, ignore: tuple[str, ...] = (), unique: bool = False, check_target: bool = False) -> DataFrame:
    """The merged rows and what became of each key, from one join.

    `mode` is "replace" (M1, M3, M4: an incoming row replaces the whole row) or
    "set" (M2: a field absent (NULL) in the incoming row keeps the old value).
    Column `_action` is `inserted`, `updated` (a value changes), `unchanged`, or
    `untouched` (the key is not in the batch). Columns in `ignore`, such as a
    load time, are merged but do not make a row `updated`. `unique` says that the
    batch states each key once.
    """
    new = _folded(incoming, keys, mode, seq, unique)
    if check_target:
        target = one_row_per_key(target, keys, "the target")
    cols = list(dict.fromkeys(target.columns + new.columns))
    o = target.withColumn("_o_hit", F.lit(1)).alias("_o")
    n = new.withColumn("_n_hit", F.lit(1)).alias("_n")
    old_there, new_there = F.col("_o_hit").isNotNull(), F.col("_n_hit").isNotNull()
    out, diffs = [], []
    for c in cols:
        was = F.col(f"_o.`{c}`") if c in target.columns else F.lit(None).cast(new.schema[c].dataType)
        now = F.col(f"_n.`{c}`") if c in new.columns else F.lit(None).cast(target.schema[c].dataType)
        value = F.when(new_there, now).otherwise(was) if mode == "replace" else F.coalesce(now, was)
        if c in keys:
            value = F.when(new_there, now).otherwise(was)
        elif c not in ignore and c in new.columns:
            same = F.to_json(now).eqNullSafe(F.to_json(was)) if isinstance(new.schema[c].dataType, MapType) else now.eqNullSafe(was)
            diffs.append(~same & (now.isNotNull() | F.lit(mode == "replace")))
        elif c not in ignore and mode == "replace":
            diffs.append(was.isNotNull())
        out.append(value.alias(c))
    any_diff = reduce(lambda a, b: a | b, diffs) if diffs else F.lit(False)
    action = F.when(~old_there, "inserted").when(~new_there, "untouched").when(any_diff, "updated").otherwise("unchanged")
    return o.join(n, _key_match("_o", "_n", keys, null_safe), "full_outer").select(*out, action.alias(ACTION))


def _folded(incoming: DataFrame, keys: list[str], mode: str, seq: str | None, unique: bool) -> DataFrame:
    if unique:
        return incoming.drop(*[seq] * (seq is not None))
    return (last_write_wins if mode == "replace" else set_fold)(incoming, keys, seq)


def replace_upsert(target: DataFrame, incoming: DataFrame, keys: list[str], seq: str | None = None, null_safe: bool = False, unique: bool = False) -> DataFrame:
    """M1 / M3 / M4: each incoming row replaces the whole target row of its key.

    Fields absent from the incoming row are NULL afterwards (replace, not
    update). Target rows whose key is not incoming are kept as they are.
    """
    new = _folded(incoming, keys, "replace", seq, unique)
    kept = target.alias("_o").join(new.select(*[_q(k) for k in keys]).alias("_n"), _key_match("_o", "_n", keys, null_safe), "left_anti")
    return kept.select(*[_q(c) for c in target.columns]).unionByName(new, allowMissingColumns=True)


def set_upsert(target: DataFrame, incoming: DataFrame, keys: list[str], seq: str | None = None, null_safe: bool = False, unique: bool = False) -> DataFrame:
    """M2: `$set` upsert; a field absent (NULL) in the incoming row keeps the old value."""
    return merge(target, incoming, keys, "set", seq, null_safe, unique=unique).drop(ACTION)


def merge_outcomes(target: DataFrame, incoming: DataFrame, keys: list[str], mode: str = "replace", null_safe: bool = False,
                   seq: str | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
    """What a merge does to each key, as counts per action (see `merge`).

    In `set` mode only the incoming non-NULL fields are compared; in `replace`
    mode every column is.
    """
    merged = merge(target, incoming, keys, mode, seq, null_safe, ignore)
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("n"))


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """M7: plain append by column name; a rerun appends the same rows again."""
    return target.unionByName(incoming, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """M8: keys held by more than one row (must be empty on a unique target)."""
    return df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
