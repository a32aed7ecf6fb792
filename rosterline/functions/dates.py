"""Calendar arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Days from the last Sunday or Monday before it to 1970-01-01, a Thursday.
DAYS_TO_EPOCH = {"sun": 4, "mon": 3}


def week_number(day: Column, first_day: str = "sun") -> Column:
    """Number of the week since 1970, for weeks that start on 'sun' or 'mon'."""
    if first_day not in DAYS_TO_EPOCH:
        raise ValueError(f"first_day must be 'sun' or 'mon', not {first_day!r}")
    return F.floor((F.unix_date(day) + DAYS_TO_EPOCH[first_day]) / 7)


def weeks_between(a: Column, b: Column, first_day: str = "sun") -> Column:
    """Week boundaries crossed from a to b, for weeks that start on 'sun' or 'mon'."""
    return (week_number(b, first_day) - week_number(a, first_day)).cast("int")


def month_diff(a: Column, b: Column) -> Column:
    """Month boundaries crossed from a to b."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def fractional_months(a: Column, b: Column) -> Column:
    """Months from a to b with the day fraction rounded to the nearest month."""
    return F.round(F.months_between(b, a, True), 0).cast("int")


def age(birth: Column, as_of: Column) -> Column:
    """Whole years from birth to as_of."""
    return F.floor(F.months_between(as_of, birth, True) / 12).cast("int")
