"""CRM activities stamped with the staff version valid on a day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cover import dense_keys
from ..operators.joins import DENSE, NODE, by_day, join_range
from ..operators.spread import (PART, HotKeys, hot_keys_each, join_parts, join_spread, ordinary,
                                repeat_right, split_left)
from ..operators.tenure import tenure_metrics
from ..operators.timeline import distinct_days
from ..sources.tables import settle

NO_COHORT = "Unidentified"
FEED_PREFIX = "properties."
OWNER, OUTCOME = ["owner_id"], ["disposition_id"]


@dataclass(frozen=True)
class StampTables:
    """Tables an activity is looked up in."""

    calendar: DataFrame      # schemas.CALENDAR, one row a day
    staff: DataFrame         # the dimension view
    cohorts: DataFrame       # schemas.COHORT
    dispositions: DataFrame  # schemas.DISPOSITION


@dataclass(frozen=True)
class TenureOptions:
    """How weeks and months are counted; see ``tenure_metrics``."""

    week_mode: str = "calendar"
    month_mode: str = "calendar"
    meeting_rule: bool = True


def strip_prefix(df: DataFrame, prefix: str = FEED_PREFIX) -> DataFrame:
    return df.toDF(*[c.replace(prefix, "") for c in df.columns])


def unify_activities(feeds: Sequence[DataFrame], prefix: str = FEED_PREFIX,
                     at: str = "activity_at") -> DataFrame:
    """All feeds in one table, columns a feed lacks null, with the day of the activity."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    return strip_prefix(union, prefix).withColumn("activity_date", F.col(at).cast("date"))


def staff_lookup(view: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Staff versions with their hire cohort, cut to what stamps show, and stored.

    The cohort depends on the hire date alone, so it is looked up here, not once per activity.
    Being stored the table tells its size, by which the planner chooses the join.
    """
    staff = join_range(
        view.select("owner_id", "valid_from", "valid_to", "person_name", "hire_date", "area",
                    "subteam", "subteam_active", "direct_report", "country", "country_2",
                    "segment"),
        cohorts.withColumnRenamed("name", "cohort"), "hire_date", "start_date", "end_date",
        hot=ordinary("_month"))
    return settle(staff.drop("start_date", "end_date").withColumnRenamed("area", "team"))


def on_calendar(df: DataFrame, calendar: DataFrame, day: Column, prefix: str = "") -> DataFrame:
    """Look a day up in the calendar; all its columns are null for a day it does not have.

    A calendar has a row a day, made sure of here, so its size is bounded and it is broadcast.
    """
    named = F.broadcast(distinct_days(calendar)).toDF(*[prefix + c for c in calendar.columns])
    return df.join(named, day == F.col(f"{prefix}dte"), "left")


def _stamp(facts: DataFrame, staff: DataFrame, calendar: DataFrame, day: Column, prefix: str,
           kind: str, options: TenureOptions, dense: DataFrame | None) -> DataFrame:
    """Stamp facts that carry part numbers; the parts stay, so a second stamp can follow."""
    dated = on_calendar(facts, calendar, day, prefix)
    at, start, end = (prefix + c for c in ("dte", "valid_from", "valid_to"))
    cohort = f"{prefix}cohort"
    dated, staff, keys = by_day(dated, staff, OWNER, at, start, end, dense)
    stamped = join_parts(dated, staff, keys, "left", F.col(at).between(
        F.col(start), F.col(end))).drop(NODE).withColumn(
        cohort, F.coalesce(cohort, F.lit(NO_COHORT)))
    return tenure_metrics(stamped, f"{prefix}dte", f"{prefix}hire_date", kind,
                          options.week_mode, options.month_mode,
                          meeting_rule=options.meeting_rule, prefix=prefix)


def _stamp_columns(prefix: str = "") -> list[str]:
    return [prefix + c for c in (
        "yyyy", "mm", "ww", "week_start", "dte", "hire_date", "days_since_entry",
        "weeks_since_entry", "months_since_entry", "actual_weeks_since_entry",
        "actual_months_since_entry", "cohort", "person_name", "team", "subteam",
        "subteam_active", "country_2")]


ACTIVITY_COLUMNS = ("activity_id", "company_id", "contact_ids", "activity_type",
                    "activity_date", "call_outcome", "meeting_outcome", "status",
                    "call_duration", "created_date")


def _with_outcome(activities: DataFrame, dispositions: DataFrame, hot: HotKeys) -> DataFrame:
    labels = dispositions.select(F.col("id").alias("disposition_id"),
                                 F.col("label").alias("call_outcome"))
    return join_spread(
        activities, labels, OUTCOME, "left", hot=hot,
        spread_by=["activity_id"]).withColumn("created_date", F.col("created_at").cast("date"))


def _sides(activities: DataFrame, tables: StampTables, hot_rows: int | None
           ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Activities and staff, ready to be joined, and the owners of many versions; if hot keys
    are asked for they are counted in one pass."""
    staff = staff_lookup(tables.staff, tables.cohorts)
    spread, outcome = hot_keys_each(activities, [OWNER, OUTCOME], hot_rows)
    facts = _with_outcome(activities, tables.dispositions, outcome)
    return (split_left(facts, spread, ["activity_id"]), repeat_right(staff, spread),
            dense_keys(staff, OWNER, DENSE))


def stamp_activities(activities: DataFrame, tables: StampTables, day: str = "activity_date",
                     options: TenureOptions = TenureOptions(),
                     hot_rows: int | None = None) -> DataFrame:
    """Activities with call outcome, calendar, staff version on the day, cohort and tenure.

    An activity on a day outside the calendar gets no staff version. One that meets several
    versions comes out several times.
    """
    facts, staff, dense = _sides(activities, tables, hot_rows)
    stamped = _stamp(facts, staff, tables.calendar, F.col(day), "", "activity_type", options,
                     dense)
    return stamped.select(*ACTIVITY_COLUMNS, *_stamp_columns())


def activity_analysis(activities: DataFrame, tables: StampTables, day: str = "activity_date",
                      creation_day: str = "created_date",
                      options: TenureOptions = TenureOptions(),
                      hot_rows: int | None = None) -> DataFrame:
    """Activities stamped twice: on their own day and on the day they were created.

    Both stamps are put on the same row one after the other, which gives what joining two
    stamped tables on the activity id gives, without that join. Both look up the same owner, so
    the activities are shuffled once.
    """
    facts, staff, dense = _sides(activities, tables, hot_rows)
    prefix = "creation_"
    at_creation = staff.toDF(*[c if c in (*OWNER, PART) else prefix + c for c in staff.columns])
    stamped = _stamp(facts, staff, tables.calendar, F.col(day), "", "activity_type", options,
                     dense)
    stamped = _stamp(stamped, at_creation, tables.calendar, F.col(creation_day), prefix,
                     "activity_type", options, dense)
    return stamped.select(*ACTIVITY_COLUMNS, *_stamp_columns(), *_stamp_columns(prefix))
