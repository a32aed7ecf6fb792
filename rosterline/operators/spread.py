"""Equi joins that hold for any size and skew.

By default a join is an ordinary one: whether to broadcast a side is left to the planner, and
skew to adaptive execution. That does not split a skewed key where the next step needs the join's
partitioning; for such joins ``hot_rows`` may be given. Rows are then counted per key, and a key
with more than ``hot_rows`` rows on the left is cut into parts: its left rows get a part number
from a hash of the row, its right rows are repeated once per part. Every left row still meets
every right row of its key exactly once, so results do not change. The hash makes the part number
the same when a task is run again.

The list of hot keys is stored, and broadcast. It cannot hold more than ``rows(left) / hot_rows``
entries: with HOT_ROWS, 10^12 left rows give at most 250,000 keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle

HOT_ROWS = 4_000_000
NULL_PARTS = 1024  # rows with a null key match nothing; they are only kept from piling up
PART = "_part"


@dataclass(frozen=True)
class HotKeys:
    """How a join on some keys is spread.

    ``table`` holds keys with very many rows and the parts each is cut into; None if there are
    none.
    """

    on: tuple[str, ...]
    table: DataFrame | None

    def __bool__(self) -> bool:
        return self.table is not None

    def named(self, *on: str) -> HotKeys:
        """The same keys under other column names."""
        if self.table is None:
            return HotKeys(on, None)
        return HotKeys(on, self.table.withColumnsRenamed(dict(zip(self.on, on))))


def ordinary(*on: str) -> HotKeys:
    """No key is cut; skew is left to adaptive execution."""
    return HotKeys(on, None)


def same_keys(on: Sequence[str], prefix: str, null_safe: bool = False) -> Column:
    """Equality of each column with its renamed partner."""
    pairs = [(F.col(k), F.col(prefix + k)) for k in on]
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def renamed(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in on})


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int | None = None) -> HotKeys:
    """Count rows per key and keep the keys with more than ``hot_rows``, if that is given."""
    return hot_keys_each(df, [on], hot_rows)[0]


def hot_keys_each(df: DataFrame, ons: Sequence[Sequence[str]],
                  hot_rows: int | None = None) -> list[HotKeys]:
    """Hot keys by several sets of columns, counted in one pass; none without ``hot_rows``."""
    if hot_rows is None:
        return [ordinary(*on) for on in ons]
    columns = list(dict.fromkeys(c for on in ons for c in on))
    if len(ons) == 1:
        grouped, which = df.groupBy(*columns), F.lit(0)
    else:
        grouped = df.groupingSets([[F.col(c) for c in on] for on in ons],
                                  *map(F.col, columns))
        which = F.grouping_id()
    table = settle(
        grouped.agg(F.count(F.lit(1)).alias("_rows"), which.cast("long").alias("_set"))
        .filter(F.col("_rows") > hot_rows)
        .select(*columns, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"), "_set")
    )
    hot_sets = {r["_set"] for r in table.select("_set").distinct().collect()}
    results = []
    for on in ons:
        # grouping_id() has a bit for every column, the first highest, set if it is left out
        number = int("".join("0" if c in on else "1" for c in columns), 2)
        mine = table.filter(F.col("_set") == number).select(*on, "_parts")
        results.append(HotKeys(tuple(on), mine if number in hot_sets else None))
    return results


def _with_parts(df: DataFrame, hot: HotKeys, null_safe: bool) -> DataFrame:
    table = renamed(hot.table, hot.on, "_hot_")
    return (
        df.join(F.broadcast(table), same_keys(hot.on, "_hot_", null_safe), "left")
        .drop(*[f"_hot_{k}" for k in hot.on])
    )


def split_left(df: DataFrame, hot: HotKeys, spread_by: Sequence[str] | None = None,
               null_safe: bool = False) -> DataFrame:
    """Add the part number to the side that has the hot keys, if there are any."""
    if not hot or PART in df.columns:
        return df
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    if not null_safe:
        no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in hot.on))
        parts = F.when(no_key, F.lit(NULL_PARTS)).otherwise(parts)
    part = F.pmod(F.xxhash64(*(spread_by or df.columns)), parts).cast("int")
    return _with_parts(df, hot, null_safe).withColumn(PART, part).drop("_parts")


def repeat_right(df: DataFrame, hot: HotKeys, null_safe: bool = False) -> DataFrame:
    """Repeat the rows of hot keys once per part, if there are any."""
    if not hot:
        return df
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    return (
        _with_parts(df, hot, null_safe)
        .withColumn(PART, F.explode(F.sequence(F.lit(0), last)))
        .drop("_parts")
    )


def join_parts(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
               where: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Join two sides made by split_left and repeat_right; the left's part number stays."""
    by_part = PART in left.columns and PART in right.columns
    keys = [*on, PART] if by_part else [*on]
    right = renamed(right, keys, "_r_")
    condition = same_keys(on, "_r_", null_safe)
    if by_part:
        condition &= F.col(PART) == F.col(f"_r_{PART}")
    if where is not None:
        condition &= where
    return left.join(right, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_spread(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                where: Column | None = None, *, hot: HotKeys | None = None,
                hot_rows: int | None = None, spread_by: Sequence[str] | None = None,
                null_safe: bool = False) -> DataFrame:
    """Join on columns both sides name alike, plus an optional condition.

    Columns other than the keys must have different names on both sides. With ``hot_rows`` hot
    keys are counted and split; ``hot`` takes the result of :func:`hot_keys`, to save counting
    when a side is costly or used again; its columns may be some of the join's.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"join_spread keeps the left side whole; how={how!r} does not")
    hot = hot_keys(left, on, hot_rows) if hot is None else hot
    left = split_left(left, hot, spread_by, null_safe)
    right = repeat_right(right, hot, null_safe)
    return join_parts(left, right, on, how, where, null_safe).drop(PART)
