"""Managers found by walking the reporting chain, now and for every calendar day.

Two choices keep the walk cheap:

* Chains are built from the top. A person's chain is the person followed by the boss's chain, so
  every join is on the direct boss. Walking up from each person instead would join on ever
  higher ancestors, until nearly all rows meet in the few people at the top. All steps but the
  last run over people who are somebody's boss.
* The daily walk joins validity periods and cuts them to their common days. Days are listed
  once, at the end, not before six joins.
* What all steps of the daily walk read is stored in buckets of the boss's name, so that a step
  shuffles only the chains that the step before has made.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import name_key
from ..functions.rules import manager_words
from ..sources.tables import settle, settle_by
from .dimview import INACTIVE, latest_version
from .spread import (PART, HotKeys, hot_keys, join_parts, join_spread, ordinary,
                     repeat_right, split_left)
from .timeline import (calendar_bounds, distinct_days, explode_days, to_calendar,
                       uncovered_days)

DEPTH = 7
NO_MANAGER = "Other"
DAYS = ("first_day", "last_day")
CHAIN = "_chain"

# What the daily result keeps of a person's own version.
OWN_COLUMNS = ("person_name", "area", "direct_report", "job_title", "job_class", "country_2",
               "segment", "active", "hire_date", "class_start", "first_role_flag")


def _nodes(versions: DataFrame, *keep: str) -> DataFrame:
    """Versions with join names and what each level of a chain has to know."""
    level = F.struct(
        F.col("person_name").alias("name"),
        F.col("job_title").alias("title"),
        F.col("job_class").alias("class"),
        F.col("termination_date").isNotNull().alias("left_company"),
        *[flag.alias(name) for name, flag in manager_words().items()],
    )
    return versions.select(
        *keep, name_key("person_name").alias("_name"), name_key("direct_report").alias("_boss"),
        level.alias("_level"))


def _add_level(nodes: DataFrame, above: DataFrame, hot: HotKeys, dated: bool) -> DataFrame:
    """Put each node before its boss's chain; ``nodes`` carry part numbers.

    In a dated walk the result is cut to the days both have in common.
    """
    above = above.withColumnsRenamed({"_name": "_boss", CHAIN: "_above"})
    where = None
    if dated:
        above = above.withColumnsRenamed({d: f"_above_{d}" for d in DAYS})
        where = ((F.col(DAYS[0]) <= F.col(f"_above_{DAYS[1]}"))
                 & (F.col(f"_above_{DAYS[0]}") <= F.col(DAYS[1])))
    joined = join_parts(nodes, repeat_right(above, hot), ["_boss"], "left", where)
    own = F.array("_level")
    chain = F.when(F.col("_above").isNull(), own).otherwise(F.concat(own, F.col("_above")))
    if dated:
        # greatest and least skip the nulls of a node without a boss
        joined = joined.withColumns({
            DAYS[0]: F.greatest(DAYS[0], f"_above_{DAYS[0]}"),
            DAYS[1]: F.least(DAYS[1], f"_above_{DAYS[1]}"),
        }).drop(*[f"_above_{d}" for d in DAYS])
    return joined.withColumn(CHAIN, chain).drop("_above", "_level")


def _hot_names(nodes: DataFrame, hot_rows: int | None) -> HotKeys:
    """Names that occur very often, as a person's own or as the boss's, in one list."""
    names = nodes.select(F.explode(F.array("_boss", "_name")).alias("_boss"))
    return hot_keys(names, ["_boss"], hot_rows)


def walk_up(nodes: DataFrame, depth: int, hot: HotKeys,
            days: tuple[Column, Column] | None = None) -> DataFrame:
    """Add ``_chain``, the levels from the node itself up to ``depth``; parts stay on.

    ``days``, the calendar's first and last, makes the walk a dated one: rows are split where
    the chain changes, and a boss without a version on some days is missing on those.
    """
    if depth < 2:
        raise ValueError("a chain has at least two levels")
    dated = days is not None
    narrow = nodes.select("_name", "_boss", "_level", *(DAYS if dated else ()))
    if dated:
        narrow = narrow.filter(F.col(DAYS[0]).isNotNull())
    names = narrow.select(F.col("_boss").alias("_name")).distinct()
    bosses = join_spread(narrow, names, ["_name"], "left_semi", hot=hot.named("_name"))
    absent = None
    if dated:
        bosses = settle_by(bosses, "_boss")
        # Days without a version are rows without a chain, so that a left join keeps them.
        absent = settle(uncovered_days(bosses, ["_name"], *DAYS, *days))
    kept = ["_name", CHAIN, *(DAYS if dated else ())]
    above = bosses.withColumn(CHAIN, F.array("_level")).select(*kept)
    bosses_in_parts = split_left(bosses, hot)
    for _ in range(depth - 2):
        full = above.unionByName(absent, allowMissingColumns=True) if dated else above
        above = _add_level(bosses_in_parts, full, hot, dated).select(*kept)
    full = above.unionByName(absent, allowMissingColumns=True) if dated else above
    return _add_level(split_left(nodes, hot), full, hot, dated)


def _level(n: int) -> Column:
    return F.get(CHAIN, F.lit(n - 1))


def _manager_test(n: int) -> str:
    """The manager test at level n; unknown, so not passed, where a level is missing."""
    here, below = f"get({CHAIN}, {n - 1})", f"get({CHAIN}, {n - 2})"
    vp = f"{here}.says_vp" + (f" and not {below}.says_manager" if n > 1 else "")
    return f"({here}.says_manager or {vp} or {here}.other_head) and not {here}.says_key"


def _with_manager_level(df: DataFrame, depth: int) -> DataFrame:
    """Add the first level that passes the test, 0 for none, and that level's struct."""
    branches = " ".join(f"when {_manager_test(n)} then {n}" for n in range(1, depth + 1))
    return (df.withColumn("manager_level", F.expr(f"case {branches} else 0 end"))
            .withColumn("_manager", F.get(CHAIN, F.col("manager_level") - 1)))


def current_manager(view: DataFrame, max_depth: int = DEPTH,
                    hot_rows: int | None = None) -> DataFrame:
    """Each person's manager by the latest versions.

    ``manager_level`` is the level found, 0 for none; ``manager`` is 'Inactive' if that person
    has left and 'Other' if there is none.
    """
    nodes = settle(_nodes(latest_version(view), "person_name", "job_title", "direct_report"))
    return _current_manager(nodes, max_depth, _hot_names(nodes, hot_rows))


def _current_manager(nodes: DataFrame, max_depth: int, hot: HotKeys) -> DataFrame:
    walked = _with_manager_level(walk_up(nodes, max_depth, hot), max_depth)
    manager = (F.when(F.col("manager_level") == 0, F.lit(NO_MANAGER))
               .when(F.col("_manager.left_company"), F.lit(INACTIVE))
               .otherwise(F.col("_manager.name")))
    levels = []
    for n in range(2, max_depth + 1):
        levels += [_level(n)["name"].alias(f"level_{n}_name"),
                   _level(n)["title"].alias(f"level_{n}_title")]
    return walked.select("person_name", "job_title", "direct_report", *levels, "manager_level",
                         manager.alias("manager"))


def open_days(view: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """Add the first and last calendar day of each version.

    Versions that end in the year after ``as_of`` or later count up to the next New Year.
    """
    horizon, capped = dt.date(as_of.year + 1, 1, 1), dt.date(as_of.year + 2, 1, 1)
    end = F.when(F.col("valid_to") >= F.lit(horizon), F.lit(capped)).otherwise(F.col("valid_to"))
    return to_calendar(view, F.col("valid_from"), end, calendar, DAYS)


def daily_roster(view: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per version and calendar day, with the calendar and the boss's own latest boss.

    Versions without a calendar day keep one row with a null day.
    """
    bosses = latest_version(view).select(
        F.col("person_name").alias("direct_report"), F.col("direct_report").alias("last_report"))
    versions = join_spread(open_days(view, calendar, as_of), bosses, ["direct_report"], "left",
                           hot=ordinary("direct_report"))
    listed = only_days(explode_days(versions).drop(*DAYS), calendar)
    return listed.select(*view.columns, *calendar.columns, "last_report")


def only_days(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Listed days with the calendar's columns, without days it lacks; null days stay."""
    days = F.broadcast(distinct_days(calendar).withColumn("_there", F.lit(True)))
    return df.join(days, "dte", "left").filter(
        F.col("dte").isNull() | F.col("_there")).drop("_there")


def manager_periods(view: DataFrame, calendar: DataFrame, as_of: dt.date,
                    current: DataFrame | None = None, max_depth: int = DEPTH,
                    hot_rows: int | None = None) -> DataFrame:
    """The daily manager as periods of days on which the whole chain stays the same.

    The first level that passes the manager test on the day is the manager. If there is none,
    it is the current manager of the boss, else 'Inactive'.
    """
    nodes = settle_by(_nodes(open_days(view, calendar, as_of), "reverse_rank_id", *OWN_COLUMNS,
                             *DAYS), "_boss")
    hot = _hot_names(nodes, hot_rows)
    if current is None:
        current = _current_manager(latest_version(nodes), max_depth, hot)
    bosses = settle(current.select(
        name_key("person_name").alias("_boss"), F.col("job_title").alias("direct_report_title"),
        F.col("manager").alias("_boss_manager")))
    walked = walk_up(nodes, max_depth, hot, calendar_bounds(calendar))
    walked = join_parts(walked, repeat_right(bosses, hot), ["_boss"]).drop(PART)
    walked = _with_manager_level(walked, max_depth)
    manager = F.when(F.col("manager_level") == 0,
                     F.coalesce("_boss_manager", F.lit(INACTIVE))).otherwise(
        F.col("_manager.name"))
    levels = []
    for n in range(2, max_depth + 1):
        levels += [_level(n)["name"].alias(f"level_{n}_name"),
                   _level(n)["class"].alias(f"level_{n}_class")]
    return walked.select(*OWN_COLUMNS, *DAYS, "direct_report_title", *levels, "manager_level",
                         manager.alias("manager"))


def daily_manager(view: DataFrame, calendar: DataFrame, as_of: dt.date,
                  current: DataFrame | None = None, max_depth: int = DEPTH,
                  hot_rows: int | None = None) -> DataFrame:
    """The manager of every person on every calendar day, with the levels of the chain."""
    return periods_to_days(
        manager_periods(view, calendar, as_of, current, max_depth, hot_rows), calendar)


def periods_to_days(periods: DataFrame, calendar: DataFrame) -> DataFrame:
    """The rows of manager_periods once per calendar day, with the days of the levels there are."""
    names = [c for c in periods.columns if c.startswith("level_") and c.endswith("_name")]
    listed = only_days(explode_days(periods), calendar.select("dte"))
    return listed.withColumns({
        c.replace("_name", "_dte"): F.when(F.col(c).isNotNull(), F.col("dte")) for c in names
    }).drop(*DAYS)
