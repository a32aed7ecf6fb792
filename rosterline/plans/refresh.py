"""Which years of a report a change of its inputs touches.

Reports are kept by year. When a table of periods that a report is made from has changed, only the
years in which a changed period lies can differ; the others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one of two tables has more often than the other; nulls equal each other."""
    columns = after.columns
    sides = before.select(*columns, F.lit(-1).alias("_side")).unionByName(
        after.select(*columns, F.lit(1).alias("_side")))
    return (sides.groupBy(*columns).agg(F.sum("_side").alias("_side"))
            .filter("_side <> 0").drop("_side"))


def touched_years(periods: DataFrame, first: str, last: str,
                  calendar: DataFrame) -> list[int | None]:
    """The calendar's years in which a day of some period lies; None if a period has no day.

    As many entries as the calendar has years, at most.
    """
    known = calendar.select(F.min("dte").alias("low"), F.max("dte").alias("high"))
    cut = periods.join(F.broadcast(known)).select(
        F.greatest(first, "low").alias("a"), F.least(last, "high").alias("b"),
        (F.col(first).isNull() | F.col(last).isNull()).alias("open"))
    years = F.when(F.col("open"), F.array(F.lit(None).cast("int"))).when(
        F.col("a") <= F.col("b"), F.sequence(F.year("a"), F.year("b")))
    rows = cut.select(F.explode(years).alias("y")).distinct().collect()
    return sorted((r["y"] for r in rows), key=lambda y: (y is not None, y))


def distinct_years(df: DataFrame, day: str) -> list[int | None]:
    """The years of a column of calendar days; None for rows without a day."""
    rows = df.select(F.year(day).alias("y")).distinct().collect()
    return sorted((r["y"] for r in rows), key=lambda y: (y is not None, y))


def in_years(day: Column, years: Sequence[int | None]) -> Column:
    """Whether a day's year, or the lack of a day, is among ``years``."""
    found = day.isNotNull() & F.year(day).isin([y for y in years if y is not None])
    return (day.isNull() | found) if None in years else F.coalesce(found, F.lit(False))


def cut_to_years(periods: DataFrame, first: str, last: str,
                 years: Sequence[int | None]) -> DataFrame:
    """Periods cut to years, one row for each of them that they touch."""
    some = F.array(*[F.lit(y) for y in years if y is not None]).cast("array<int>")
    parts = periods.withColumn("_year", F.explode(F.filter(
        some, lambda y: (y >= F.year(first)) & (y <= F.year(last)))))
    new_year = F.make_date("_year", F.lit(1), F.lit(1))
    cut = parts.withColumns({
        first: F.greatest(F.col(first), new_year),
        last: F.least(F.col(last), F.make_date("_year", F.lit(12), F.lit(31))),
    }).drop("_year")
    return cut.unionByName(periods.filter(F.col(first).isNull())) if None in years else cut
