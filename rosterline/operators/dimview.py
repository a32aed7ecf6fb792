"""The ranked and classified view of the staff dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age
from ..functions.names import name_key
from ..functions.rules import ROLE_RULES, Rule, classify, is_leader
from ..schemas import VIEW_COLUMNS
from .groups import rank_in_group, with_group_values
from .spread import HotKeys, hot_keys

INACTIVE = "Inactive"


def subteam(title: str, name: Column, boss: Column) -> Column:
    """Leaders are their own subteam, others belong to their boss."""
    return F.when(is_leader(title), name).otherwise(boss)


def subteam_active(title: str, name: Column, active: Column, boss: Column) -> Column:
    """As :func:`subteam`, with leaders who left marked and the effective boss for others."""
    own = F.when(active == 0, F.lit(INACTIVE)).otherwise(name)
    return F.when(is_leader(title), own).otherwise(boss)


def first_role(df: DataFrame, person: str = "person_name", role: str = "job_class",
               start: str = "valid_from", hired: str = "hire_date",
               hot: HotKeys | None = None) -> DataFrame:
    """Add the day a person first held the role, and whether that is the hire date."""
    df = with_group_values(df, [person, role], {"class_start": F.min(start)}, hot=hot)
    flag = F.when(F.col("class_start") == F.col(hired), 1).otherwise(0)
    return df.withColumn("first_role_flag", flag)


def ranked_versions(dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Versions numbered per person from the oldest and from the latest; ties go by id."""
    return (
        rank_in_group(dim, ["person_name"], order="valid_from", tie="id", size="_versions",
                      hot=hot)
        .withColumn("reverse_rank_id", F.col("_versions") - F.col("rank_id") + 1)
        .drop("_versions")
    )


def dim_view(dim: DataFrame, as_of: dt.date, rules: Sequence[Rule] = ROLE_RULES,
             hot_rows: int | None = None) -> DataFrame:
    """The dimension with ranks, adjusted starts, subteams, role class, age and first role.

    Versions touch in the dimension; in the view each later one starts a day after the one
    before ends. ``active`` holds for a person's whole tenure.
    """
    named = dim.withColumns({c: name_key(c) for c in ("person_name", "direct_report")})
    # A group within a person who is not hot is not hot either.
    hot = hot_keys(named, ["person_name"], hot_rows)
    if not hot:  # one shuffle for all windows, which are by person and something else
        named = named.repartition("person_name")
    ranked = with_group_values(ranked_versions(named, hot), ["person_name", "tenure_no"],
                               {"_active": F.min("active")}, hot=hot)
    first = F.col("rank_id") == 1
    start, day_after = F.col("valid_from"), F.date_add("valid_from", 1)
    title, name = "job_title", F.col("person_name")
    shaped = ranked.withColumns({
        "active": F.col("_active"),
        "valid_from": F.when(first, start).otherwise(day_after),
        "valid_from_month_start": F.when(first, F.trunc(start, "month")).otherwise(day_after),
        "subteam": subteam(title, name, F.col("direct_report")),
        "subteam_active": subteam_active(
            title, name, F.col("_active"), F.col("effective_boss")),
        "job_class": classify(title, rules=rules),
        "age": age(F.col("birth_date"), F.lit(as_of)),
    })
    return first_role(shaped, hot=hot).select(*VIEW_COLUMNS)


def latest_version(view: DataFrame) -> DataFrame:
    """Each person's latest version."""
    return view.filter(F.col("reverse_rank_id") == 1)
