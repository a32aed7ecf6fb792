"""Contacts with company, staff version at creation, adjusted date, manager and tenure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import weeks_between
from ..functions.rules import first_match
from ..operators.cover import dense_keys
from ..operators.joins import DENSE, NODE, by_day
from ..operators.spread import (PART, hot_keys_each, join_parts, join_spread, ordinary,
                                repeat_right, split_left)
from ..operators.tenure import tenure_metrics
from ..sources.tables import settle
from .activity import NO_COHORT, OWNER, on_calendar, staff_lookup

# Days by which a creation date moves, by week of tenure.
SHIFTS = ((1, 6), (4, 6), (3, 13))
SHIFT_ELSE = -1
CONTACTED_WITHIN = 5


@dataclass(frozen=True)
class ContactTables:
    companies: DataFrame        # schemas.COMPANY
    calendar: DataFrame         # schemas.CALENDAR, one row a day
    staff: DataFrame            # the dimension view
    cohorts: DataFrame          # schemas.COHORT
    manager_periods: DataFrame  # from hierarchy.manager_periods, or daily with equal ends


def shifted_day(created: Column, hired: Column) -> Column:
    """The creation day moved by the week of tenure it falls in (Sunday weeks, a day earlier)."""
    week = weeks_between(hired, F.date_sub(created, 1), "sun") + 1
    days = first_match([(week == w, F.lit(d)) for w, d in SHIFTS], F.lit(SHIFT_ELSE))
    return F.date_add(created, days)


def adjusted_date(df: DataFrame, created: str, hired: str, calendar: DataFrame) -> DataFrame:
    """Add the calendar columns of the adjusted date as ``adj_*``.

    The moved day and the day after it must both be in the calendar, else all are null.
    """
    moved = on_calendar(df, calendar.select("dte"), shifted_day(F.col(created), F.col(hired)),
                        "_moved_")
    return on_calendar(moved, calendar, F.date_add("_moved_dte", 1), "adj_").drop("_moved_dte")


def contact_analysis(contacts: DataFrame, tables: ContactTables,
                     hot_rows: int | None = None) -> DataFrame:
    """One row per contact and staff version valid on its creation day."""
    by_id = ["contact_id"]
    companies = tables.companies.select("company_id", "row_tag")
    calendar = tables.calendar
    staff = staff_lookup(tables.staff, tables.cohorts)
    # Managers are keyed by owner too, so that the parts of hot owners serve for their join.
    managers = settle(join_spread(
        tables.manager_periods.select("person_name", "first_day", "last_day", "manager"),
        staff.select("owner_id", "person_name").distinct(), ["person_name"], "inner",
        hot=ordinary("person_name")))
    by_person = [*OWNER, "person_name"]
    to_company, to_owner = hot_keys_each(contacts, [["company_id"], OWNER], hot_rows)
    facts = join_spread(contacts, companies, ["company_id"], "left", hot=to_company,
                        spread_by=by_id)
    dated = on_calendar(facts, calendar, F.col("created_at").cast("date"), "original_")
    valid = F.col("original_dte").between(F.col("valid_from"), F.col("valid_to"))
    dated, versions, keys = by_day(
        split_left(dated, to_owner, by_id), repeat_right(staff, to_owner), OWNER, "original_dte",
        "valid_from", "valid_to", dense_keys(staff, OWNER, DENSE))
    owned = join_parts(dated, versions, keys, "left", valid).drop(NODE)
    adjusted = adjusted_date(owned, "original_dte", "hire_date", calendar)
    on_day = F.col("adj_dte").between(F.col("first_day"), F.col("last_day"))
    adjusted, periods, keys = by_day(
        split_left(adjusted, to_owner, by_id), repeat_right(managers, to_owner), by_person,
        "adj_dte", "first_day", "last_day", dense_keys(managers, by_person, DENSE))
    managed = join_parts(adjusted, periods, keys, "left", on_day).drop(PART, NODE)
    # Adjusted dates count Monday weeks, original ones Sunday weeks.
    metrics = tenure_metrics(managed, "adj_dte", "hire_date", first_day="mon")
    metrics = tenure_metrics(metrics, "original_dte", "hire_date", first_day="sun",
                             prefix="original_", actual_prefix="actual_original_")
    soon = F.col("last_contacted_at") <= F.date_add("original_dte", CONTACTED_WITHIN)
    return metrics.select(
        "contact_id", "company_id",
        *[F.col(f"adj_{c}").alias(c) for c in ("yyyy", "mm", "ww", "week_start", "dte")],
        *[f"original_{c}" for c in ("yyyy", "mm", "ww", "week_start", "dte")],
        "hire_date", "days_since_entry", "weeks_since_entry", "months_since_entry",
        "original_days_since_entry", "original_weeks_since_entry",
        "original_months_since_entry", "actual_weeks_since_entry", "actual_months_since_entry",
        "actual_original_weeks_since_entry", "actual_original_months_since_entry",
        F.coalesce("cohort", F.lit(NO_COHORT)).alias("creation_cohort"),
        "person_name", "team", "subteam", "subteam_active", "country", "manager", "country_2",
        "segment", "source_label",
        F.when(soon, 1).otherwise(0).alias("contacted_soon"),
        F.lit(1).alias("contact_created"),
        F.when(F.col("row_tag").isNotNull(), 1).otherwise(0).alias("has_row_tag"),
        "lead_label",
    )
