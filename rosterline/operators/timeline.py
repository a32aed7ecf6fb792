"""Operations on day intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar_bounds(calendar: DataFrame) -> tuple[Column, Column]:
    """First and last day of a calendar, as scalar subqueries."""
    return calendar.agg(F.min("dte")).scalar(), calendar.agg(F.max("dte")).scalar()


def distinct_days(calendar: DataFrame) -> DataFrame:
    """The calendar with one row a day at most: never more rows than a date has values."""
    return calendar.filter(F.col("dte").isNotNull()).dropDuplicates(["dte"])


def calendar_index(calendar: DataFrame) -> Column:
    """The days of a calendar in order, and for each day from the first to the last how many lie
    before it, as a scalar subquery: a struct of ``days`` and ``before``.

    One task looks at all days, of which a calendar cannot have many.
    """
    in_order = Window.orderBy("dte")
    days = distinct_days(calendar).select(
        "dte", (F.row_number().over(in_order) - 1).alias("n"),
        F.coalesce(F.lead("dte").over(in_order), F.date_add("dte", 1)).alias("next"))
    # A day itself has n before it, the days missing after it have one more.
    each = days.select("dte", F.explode(F.concat(F.array("n"), F.array_repeat(
        F.col("n") + 1, F.datediff("next", "dte") - 1))).alias("before"))
    lists = F.sort_array(F.collect_list(F.struct("dte", "before")))
    return each.agg(F.struct(
        F.array_sort(F.collect_set("dte")).alias("days"),
        F.transform(lists, lambda x: x.before).alias("before"))).scalar()


def to_calendar(df: DataFrame, start: Column, end: Column, calendar: DataFrame,
                into: tuple[str, str] = ("first_day", "last_day")) -> DataFrame:
    """Add the first and the last day of the calendar within each interval; null if none is.

    Two lookups by place in what :func:`calendar_index` lists: no join.
    """
    looked = df.withColumns({"_index": calendar_index(calendar), "_from": start, "_to": end})
    days, before = F.col("_index.days"), F.col("_index.before")

    def days_before(day: Column) -> Column:
        place = F.greatest(F.datediff(day, F.get(days, F.lit(0))), F.lit(0))
        return F.coalesce(F.get(before, place), F.size(days))

    first, after = days_before(F.col("_from")), days_before(F.date_add("_to", 1))
    real = F.col("_from").isNotNull() & F.col("_to").isNotNull() & (first < after)
    return looked.withColumns({
        into[0]: F.when(real, F.get(days, first)), into[1]: F.when(real, F.get(days, after - 1)),
    }).select(*df.columns, *into)


def explode_days(df: DataFrame, first: str = "first_day", last: str = "last_day",
                 day: str = "dte") -> DataFrame:
    """One row per day of the interval; rows without one keep a null day.

    ``sequence`` would count down for a start after the end, so intervals must be clipped first.
    """
    days = F.when(F.col(first) <= F.col(last), F.sequence(F.col(first), F.col(last)))
    return df.select("*", F.explode_outer(days).alias(day))


def depth_changes(df: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """Per key the days on which the number of intervals that hold the day changes, with
    ``change``, by how much; intervals without days count nothing.

    Two rows per interval, summed before the shuffle: per key a row a day at most.
    """
    given = df.filter(F.col(first) <= F.col(last))
    ends = F.explode(F.array(
        F.struct(F.col(first).alias("day"), F.lit(1).alias("change")),
        F.struct(F.date_add(last, 1).alias("day"), F.lit(-1).alias("change"))))
    return (given.select(*keys, ends.alias("_end")).groupBy(*keys, F.col("_end.day").alias("day"))
            .agg(F.sum("_end.change").alias("change")).filter("change <> 0"))


def overlap_periods(df: DataFrame, keys: Sequence[str], first: str, last: str,
                    at_least: int = 2) -> DataFrame:
    """Per key the periods that ``at_least`` intervals hold, with ``depth``, how many they are.

    A sweep over the days on which that number changes; no day is listed. Null keys form a group.
    Periods are cut where the depth changes.
    """
    by_day = Window.partitionBy(*keys).orderBy("day")
    swept = depth_changes(df, keys, first, last).select(
        *keys, F.col("day").alias("from_day"),
        F.date_sub(F.lead("day").over(by_day), 1).alias("to_day"),
        F.sum("change").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return swept.filter(F.col("depth") >= at_least)


def duplicate_days(df: DataFrame, keys: Sequence[str], first: str, last: str,
                   calendar: DataFrame, day: str = "dte") -> DataFrame:
    """Keys and calendar days that several intervals hold, with ``row_count``, how many.

    Days are listed at the end, and only those. A key of which two or more rows have no day of
    the calendar comes with a null day.
    """
    held = to_calendar(df, F.col(first), F.col(last), calendar, ("_first", "_last"))
    periods = overlap_periods(held, keys, "_first", "_last")
    days = F.broadcast(distinct_days(calendar).select(F.col("dte").alias(day)))
    listed = explode_days(periods, "from_day", "to_day", day).join(days, day).select(
        *keys, day, F.col("depth").cast("long").alias("row_count"))
    none = (held.filter(F.col("_first").isNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1"))
    return listed.unionByName(none.withColumn(day, F.lit(None).cast("date")))


def uncovered_days(df: DataFrame, keys: Sequence[str], first: str, last: str,
                   low: Column, high: Column) -> DataFrame:
    """Per key, the maximal intervals of [low, high] that no row covers.

    Rows are first cut down to the latest end per key and start day, so the window sees at most
    one row per calendar day and key, however many rows a key has.
    """
    starts = (df.filter(F.col(first).isNotNull())
              .groupBy(*keys, first).agg(F.max(last).alias(last)))
    so_far = (Window.partitionBy(*keys).orderBy(first)
              .rowsBetween(Window.unboundedPreceding, -1))
    inner = starts.select(
        *keys,
        F.coalesce(F.date_add(F.max(last).over(so_far), 1), low).alias("_from"),
        F.date_sub(first, 1).alias("_to"),
    )
    tail = starts.groupBy(*keys).agg(
        F.date_add(F.max(last), 1).alias("_from")).withColumn("_to", high)
    return (
        inner.unionByName(tail).filter(F.col("_from") <= F.col("_to"))
        .withColumnsRenamed({"_from": first, "_to": last})
    )
