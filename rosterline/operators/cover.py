"""Closed ranges of days as few pieces of the calendar, so that days find ranges by equality.

Pieces are one day long, or 8, 64 and so on, and a piece of each length begins where the one
before ends. A range is cut into the longest pieces that fit, at most 14 of a length. A day lies in
one piece of each length, so it is looked up once per length, and it meets a range in exactly one
of them or in none. Unlike a join on the key with a condition on the days, no pair is looked at
that does not match, however many ranges a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle

PIECE = "_piece"
BITS = 3
LENGTHS = 6  # the longest pieces have 90 years, of which a date's range holds 112


def _piece(number: Column, k: int) -> Column:
    """The pieces of one length, counted from 1970, told apart from those of the others."""
    return number * LENGTHS + k


def _numbers(first: Column, after: Column) -> Column:
    """All whole numbers from one to the one before another; none if there are none."""
    return F.when(first < after, F.sequence(first, after - 1)).otherwise(
        F.array().cast("array<int>"))


def pieces_with(day: Column) -> Column:
    """The pieces a day lies in, one of each length."""
    number = F.unix_date(day)
    return F.when(day.isNotNull(), F.array(*[
        _piece(F.shiftright(number, BITS * k), k) for k in range(LENGTHS)]))


def cover(first: Column, last: Column) -> Column:
    """The pieces of the days from ``first`` to ``last``; none if the range is empty or open."""
    begin, end = F.unix_date(first), F.unix_date(last) + 1

    def pieces(numbers: Column, k: int) -> Column:
        return F.transform(numbers, lambda n: _piece(n, k))

    def within(k: int) -> tuple[Column, Column]:
        """The first piece of a length that is all in the range, and the one after the last."""
        return (F.shiftright(begin + ((1 << BITS * k) - 1), BITS * k), F.shiftright(end, BITS * k))

    found = []
    for k in range(LENGTHS):
        low, high = within(k)
        numbers = _numbers(low, high)
        if k + 1 < LENGTHS:  # without what longer pieces hold
            next_low, next_high = within(k + 1)
            numbers = F.when(next_low < next_high, F.concat(
                _numbers(low, next_low * (1 << BITS)),
                _numbers(next_high * (1 << BITS), high))).otherwise(numbers)
        found.append(pieces(numbers, k))
    return F.when(first <= last, F.concat(*found)).otherwise(F.array().cast("array<int>"))


def inside(points: DataFrame, ranges: DataFrame, on: Sequence[str], at: str, start: str,
           end: str) -> DataFrame:
    """Pairs of points and ranges with the same key, the point's day in the range.

    The planner takes a listed side for as large as what it is listed from, and would send some
    hundred times that to the driver and to every task, so both sides are shuffled.
    """
    days = points.withColumn(PIECE, F.explode(pieces_with(F.col(at))))
    parts = ranges.withColumn(PIECE, F.explode(cover(F.col(start), F.col(end))))
    return days.join(parts.hint("merge"), [*on, PIECE]).drop(PIECE)


def dense_keys(df: DataFrame, on: Sequence[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows, stored; None without any. Runs a job.

    The list stays a table, and how it is joined is left to the planner.
    """
    found = (df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
             .filter(F.col("_rows") > limit).drop("_rows").dropna())
    return None if found.isEmpty() else settle(found)
