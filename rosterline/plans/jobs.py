"""The jobs of the daily chain: each reads tables and replaces one.

Order: land the tabs (``sources.land_tables``), dimension, view, then managers, activities and
contacts. Jobs count hot keys and split them; a call of an operator does so only if it is told to.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dimview import dim_view
from ..operators.hierarchy import DAYS, manager_periods, periods_to_days
from ..operators.spread import HOT_ROWS
from ..sources.tables import read, read_first, scratch, write, write_partitions
from ..sources.versions import (commit, latest, open_version, read_version, stage_version,
                                write_version)
from .activity import (FEED_PREFIX, StampTables, TenureOptions, activity_analysis, on_calendar,
                       unify_activities)
from .contacts import ContactTables, contact_analysis
from .refresh import changed_rows, cut_to_years, distinct_years, in_years, touched_years
from .scd2_run import RunOptions, load_dim, scd2_run

YEAR = ["yyyy"]
ROWS_PER_FILE = 2_000_000


def dimension_job(spark: SparkSession, history: str, seed: str, snapshot: str, leavers: str,
                  options: RunOptions, overrides: DataFrame | None = None) -> None:
    """Take a snapshot and a leavers list into the history, or into the seed on the first run.

    The history is its own input and cannot be made again, so each run writes a new version of
    it. A run that fails leaves the last version as it was, and the next one starts from there.
    """
    with scratch(spark):
        dim = load_dim(read_first(spark, [history, seed]))
        result = scd2_run(dim, read(spark, snapshot), read(spark, leavers), options, overrides)
        write_version(result, history)


def view_job(spark: SparkSession, dim: str, out: str, as_of: dt.date) -> None:
    """The view as a new version, so that later jobs can tell what has changed since one."""
    with scratch(spark):
        view = dim_view(load_dim(read(spark, dim)), as_of, hot_rows=HOT_ROWS)
        write_version(view, out, sort_by=["person_name", "valid_from"])


def days_by_year(periods: DataFrame, calendar: DataFrame, years: Sequence[int | None],
                 rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """The daily rows of some years, gathered by year and in order of person and day.

    The periods are moved and sorted, not the many days that are listed from them. Those of one
    person and the same days are told apart by a hash, so that they too can lie in several files.
    """
    cut = cut_to_years(periods, *DAYS, years).withColumns({
        "yyyy": F.year(DAYS[0]), "_tie": F.xxhash64(*periods.columns)})
    listed = F.coalesce(F.datediff(DAYS[1], DAYS[0]) + 1, F.lit(1))
    rows = cut.agg(F.sum(listed.cast("long"))).first()[0] or 0
    order = ["yyyy", "person_name", *DAYS, "_tie"]
    placed = cut.repartitionByRange(max(1, math.ceil(rows / rows_per_file)), *order)
    return periods_to_days(placed.sortWithinPartitions(*order).drop("_tie"), calendar)


def manager_job(spark: SparkSession, view: str, calendar: str, out: str, periods_out: str,
                as_of: dt.date) -> list[int | None]:
    """Daily managers by year, and the periods they come from, which the contact job reads.

    The periods are kept in versions. Only years in which a period has changed since the last
    version are written; returns them. The new periods are committed when that is done, so a run
    that stops before is made good by the next one. A changed calendar, or an ``out`` that is
    gone, needs a fresh ``periods_out`` too.
    """
    staff, days = read(spark, view), read(spark, calendar)
    with scratch(spark):
        staged = stage_version(manager_periods(staff, days, as_of, hot_rows=HOT_ROWS),
                               periods_out, sort_by=["person_name", "first_day"])
    periods = open_version(spark, periods_out, staged)
    before = latest(spark, periods_out)
    if before is None:
        years = touched_years(periods, *DAYS, days)
        write(days_by_year(periods, days, years), out, YEAR, placed=True)
    else:
        changes = changed_rows(open_version(spark, periods_out, before), periods)
        years = touched_years(changes, *DAYS, days)
        write_partitions(days_by_year(periods, days, years), out, *YEAR, years, placed=True)
    commit(spark, periods_out, staged)
    return years


def activity_job(spark: SparkSession, feeds: Sequence[str], view: str, calendar: str,
                 cohorts: str, dispositions: str, out: str, prefix: str = FEED_PREFIX,
                 options: TenureOptions = TenureOptions(), since: int | None = None
                 ) -> tuple[int | None, list[int | None]]:
    """Activities with both stamps, by year of the activity.

    Returns the version of the view it has used, and the years it wrote. With ``since``, the
    version that ``out`` was made from, only years are written that hold an activity done or
    created in a year in which the view has changed; feeds, cohorts and calendar must be the same.
    """
    version = latest(spark, view)
    tables = StampTables(*(read(spark, p) for p in (calendar, view, cohorts, dispositions)))
    activities = unify_activities([read(spark, p) for p in feeds], prefix)
    # The year of a row is that of its day in the calendar; null for a day the calendar lacks.
    dated = on_calendar(activities, tables.calendar.select("dte"), F.col("activity_date"), "_")
    with scratch(spark):
        if since is None:
            years = distinct_years(dated, "_dte")
            write(activity_analysis(activities, tables, options=options, hot_rows=HOT_ROWS), out,
                  YEAR)
        else:
            changes = changed_rows(read_version(spark, view, since), tables.staff).filter(
                F.col("valid_from") <= F.col("valid_to"))
            changed = touched_years(changes, "valid_from", "valid_to", tables.calendar)
            on_created = in_years(F.col("created_at").cast("date"), changed)
            years = distinct_years(
                dated.filter(in_years(F.col("_dte"), changed) | on_created), "_dte")
            kept = dated.filter(in_years(F.col("_dte"), years)).drop("_dte")
            write_partitions(activity_analysis(kept, tables, options=options, hot_rows=HOT_ROWS),
                             out, *YEAR, years)
    return version and version.number, years


def contact_job(spark: SparkSession, contacts: str, companies: str, view: str, calendar: str,
                cohorts: str, periods: str, out: str) -> None:
    """Contacts with company, staff version, manager and tenure, by year."""
    tables = ContactTables(*(read(spark, p) for p in (companies, calendar, view, cohorts,
                                                      periods)))
    with scratch(spark):
        write(contact_analysis(read(spark, contacts), tables, HOT_ROWS), out, YEAR)
