"""Joins of the history model: lookups by version, by range and by overlap.

A key has few versions as a rule, and each fact is compared with all of its key's. Keys with more
than ``DENSE`` versions are looked up by pieces of the calendar instead (``cover``), so that the
work grows with facts, versions and matches, not with facts times versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle
from .cover import dense_keys, inside
from .spread import HotKeys, join_spread

DENSE = 128
NODE = "_node"


def not_in(left: DataFrame, right: DataFrame, on: Sequence[str], **spread) -> DataFrame:
    """Left rows without a partner; a null key has none."""
    return join_spread(left, right.select(*on).distinct(), on, "left_anti", **spread)


def matched(left: DataFrame, right: DataFrame, on: Sequence[str], **spread) -> DataFrame:
    """Left rows with their partners."""
    return join_spread(left, right, on, "inner", **spread)


def changed(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """Whether any pair differs; by default a change from or to null does not count."""
    result = F.lit(False)
    for old, new in pairs:
        differs = ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))
        result = result | differs
    return result


def update_from(df: DataFrame, updates: DataFrame, on: Sequence[str],
                cols: Sequence[str]) -> DataFrame:
    """Take ``cols`` from the update with the same key, where it has a value.

    If a key has several updates, the greatest value is taken, so that no row is multiplied.
    """
    updates = updates.groupBy(*on).agg(*[F.max(c).alias(f"_new_{c}") for c in cols])
    return (
        df.join(updates, list(on), "left")
        .withColumns({c: F.coalesce(f"_new_{c}", c) for c in cols})
        .select(*df.columns)
    )


def by_day(facts: DataFrame, dim: DataFrame, on: Sequence[str], at: str, start: str, end: str,
           found: DataFrame | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a version lookup made ready for a join on the keys returned.

    ``found`` has the keys of many versions (:func:`dense_keys`). Without any, nothing changes.
    Else their versions are found for each day that their facts have, by pieces of the calendar,
    and facts and versions of them meet on key and day, so that such a key is also spread over
    its days. Stores the days of each key.
    """
    if found is None:
        return facts, dim, [*on]
    no_day = F.lit("0001-01-01").cast("date")
    flagged = facts.join(found.withColumn("_dense", F.lit(True)), [*on], "left")
    placed = flagged.withColumn(
        NODE, F.when(F.col("_dense"), F.col(at)).otherwise(no_day)).select(*facts.columns, NODE)
    days = settle(facts.join(found, [*on], "left_semi").select(*on, F.col(at).alias(NODE))
                  .filter(F.col(NODE).isNotNull()).distinct())
    few = dim.join(found, [*on], "left_anti").withColumn(NODE, no_day)
    # Versions of keys without a fact meet nothing, so they are not cut into pieces.
    asked = days.select(*on).distinct()
    many = inside(days, dim.join(asked, [*on], "left_semi"), on, NODE, start, end)
    return placed, few.unionByName(many), [*on, NODE]


def join_valid_at(facts: DataFrame, dim: DataFrame, on: Sequence[str], at: str,
                  start: str = "valid_from", end: str = "valid_to", how: str = "left",
                  hot: HotKeys | None = None, hot_rows: int | None = None,
                  spread_by: Sequence[str] | None = None, dense: int = DENSE) -> DataFrame:
    """Facts with the dimension versions valid on their day, both ends included.

    A fact can meet none or several versions; all are kept.
    """
    facts, dim, keys = by_day(facts, dim, on, at, start, end, dense_keys(dim, on, dense))
    return join_spread(facts, dim, keys, how, F.col(at).between(F.col(start), F.col(end)),
                       hot=hot, hot_rows=hot_rows, spread_by=spread_by).drop(NODE)


def ends_within(a_start: Column, a_end: Column, b_start: Column, b_end: Column,
                full_overlap: bool = False) -> Column:
    """Whether a's first or last day lies in b.

    That misses an a which goes beyond b on both sides; ``full_overlap`` takes it in.
    """
    if full_overlap:
        return (a_start <= b_end) & (b_start <= a_end)
    return a_start.between(b_start, b_end) | a_end.between(b_start, b_end)


def join_overlapping(a: DataFrame, b: DataFrame, on: Sequence[str],
                     a_days: tuple[str, str], b_days: tuple[str, str], how: str = "left",
                     full_overlap: bool = False, dense: int = DENSE, **spread) -> DataFrame:
    """Rows of a with the rows of b that have the same key and touch its days.

    Keys with many rows on both sides are looked up by pieces of the calendar.
    """
    where = ends_within(*map(F.col, a_days), *map(F.col, b_days), full_overlap)
    many = dense_keys(b, on, dense)
    if many is not None:
        many = dense_keys(a.join(many, [*on], "left_semi"), on, dense)
    if many is None:
        return join_spread(a, b, on, how, where, **spread)
    few = join_spread(a.join(many, [*on], "left_anti"), b, on, how, where, **spread)
    mine = settle(a.join(many, [*on], "left_semi").withColumn(
        "_row", F.monotonically_increasing_id()))
    pairs = touching(mine.select("_row", *on, *a_days), b.join(many, [*on], "left_semi"), on,
                     a_days, b_days, full_overlap).drop(*on, *a_days)
    if how in ("left_semi", "left_anti"):
        pairs = pairs.select("_row").distinct()
    return few.unionByName(mine.join(pairs, "_row", how).drop("_row").select(*few.columns))


def touching(a: DataFrame, b: DataFrame, on: Sequence[str], a_days: tuple[str, str],
             b_days: tuple[str, str], full_overlap: bool = False) -> DataFrame:
    """Pairs with the same key that touch by :func:`ends_within`, from lookups of single days.

    Either a's first day lies in b, or, each pair once, what the rule names besides: a's last
    day in b, or, for the full overlap, b's first day in a.
    """
    a_start, b_start = F.col(a_days[0]), F.col(b_days[0])
    begins = inside(a, b, on, a_days[0], *b_days)
    if full_overlap:
        others = inside(b, a, on, b_days[0], *a_days).filter(a_start < b_start)
        where = ends_within(*map(F.col, a_days), *map(F.col, b_days), True)
        return begins.unionByName(others).filter(where)
    within = F.coalesce(a_start.between(b_start, F.col(b_days[1])), F.lit(False))
    return begins.unionByName(inside(a, b, on, a_days[1], *b_days).filter(~within))


def join_range(df: DataFrame, ranges: DataFrame, at: str, start: str, end: str,
               how: str = "left", **spread) -> DataFrame:
    """Rows with the closed date ranges that hold their day; no key is needed.

    Ranges are repeated once per month they touch, so that the month serves as the join key and
    no nested loop is planned. A day has one month, so no range is met twice.
    """
    month = F.trunc(F.col(at), "month")
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    by_month = ranges.filter(F.col(start) <= F.col(end)).withColumn(
        "_month", F.explode(F.sequence(first, last, F.expr("interval 1 month"))))
    return join_spread(df.withColumn("_month", month), by_month, ["_month"], how,
                       F.col(at).between(F.col(start), F.col(end)), **spread).drop("_month")
