"""Time since hiring at an event, in days, weeks and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fractional_months, month_diff, weeks_between

# Fixed values.
LAST_WEEK = 12         # later weeks count as one week more
LAST_MONTH = 7         # later months count as this one
EARLY_HIRE_DAY = 15    # hired by this day, the first month counts in full
MEETING_DAYS = (0, 7)  # meetings this soon after hiring belong to week 2
MEETING_WEEK = 2


def cap(col: Column, limit: int, beyond: int) -> Column:
    """The value up to the limit, else ``beyond``; null counts as beyond."""
    return F.when(col <= limit, col).otherwise(F.lit(beyond))


def tenure_metrics(df: DataFrame, event: str, start: str, kind: str | None = None,
                   week_mode: str = "calendar", month_mode: str = "calendar",
                   first_day: str = "mon", meeting_rule: bool = False, prefix: str = "",
                   actual_prefix: str | None = None) -> DataFrame:
    """Add days, weeks and months from ``start`` to ``event``, capped and uncapped.

    Weeks are calendar weeks counted from 1, or with ``week_mode='days'`` the number of days.
    Months are month boundaries, or with ``month_mode='rounded'`` fractional months rounded.
    ``meeting_rule`` needs ``kind``, the column with the event type.
    """
    at, since = F.col(event), F.col(start)
    days = F.datediff(at, since) + 1
    if week_mode == "calendar":
        weeks = weeks_between(since, at, first_day) + 1
    elif week_mode == "days":
        weeks = days
    else:
        raise ValueError(f"week_mode must be 'calendar' or 'days', not {week_mode!r}")
    if month_mode == "calendar":
        months = month_diff(since, at)
    elif month_mode == "rounded":
        months = fractional_months(since, at)
    else:
        raise ValueError(f"month_mode must be 'calendar' or 'rounded', not {month_mode!r}")
    months = months + F.when(F.dayofmonth(since) <= EARLY_HIRE_DAY, 1).otherwise(0)
    actual = f"{prefix}actual_" if actual_prefix is None else actual_prefix
    df = df.withColumns({
        f"{prefix}days_since_entry": days,
        f"{actual}weeks_since_entry": weeks.cast("int"),
        f"{actual}months_since_entry": months.cast("int"),
    })
    days, weeks, months = (F.col(c) for c in df.columns[-3:])
    capped_weeks = cap(weeks, LAST_WEEK, LAST_WEEK + 1)
    if meeting_rule:
        if kind is None:
            raise ValueError("meeting_rule needs the kind column")
        soon = (F.col(kind) == "MEETING") & days.between(*MEETING_DAYS)
        capped_weeks = F.when(soon, MEETING_WEEK).otherwise(capped_weeks)
        weeks = F.when(soon, MEETING_WEEK).otherwise(weeks)
    return df.withColumns({
        f"{actual}weeks_since_entry": weeks,
        f"{prefix}weeks_since_entry": capped_weeks,
        f"{prefix}months_since_entry": cap(months, LAST_MONTH, LAST_MONTH),
    })
