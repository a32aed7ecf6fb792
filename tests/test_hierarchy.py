from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterline.operators import (current_manager, daily_manager, daily_roster, dim_view,
                                  duplicate_keys, explode_days, manager_periods, uncovered_days)
from rosterline.schemas import OPEN_END, VIEW_COLUMNS
from tests.helpers import bag, calendar, day, rows, staff

AS_OF = day("2020-03-01")
TITLES = ("Sales Manager", "VP Sales", "Key Account Manager", "SDR Intern", "Head of Care")


def is_manager(person, below):
    title, area = (person["job_title"] or "").lower(), (person["area"] or "").lower()
    if person["job_title"] is None:
        return False
    vp = "vp sales" in title and (below is None or "manager" not in below["job_title"].lower())
    head = "head" in title and "sales" not in area and "growth" not in area
    return ("manager" in title or vp or head) and "key" not in title


def chains(start, people_on):
    """All chains of up to seven people from a row; a name can have several rows."""
    done, open_chains = [], [[start]]
    while open_chains:
        chain = open_chains.pop()
        above = people_on(chain[-1]["direct_report"]) if len(chain) < 7 else []
        if above:
            open_chains += [chain + [p] for p in above]
        else:
            done.append(chain)
    return done


def level(chain):
    for n, person in enumerate(chain, start=1):
        if is_manager(person, chain[n - 2] if n > 1 else None):
            return n
    return 0


def brute_current(view):
    newest = [p for p in view if p["reverse_rank_id"] == 1]
    by_name = {p["person_name"]: p for p in newest}
    result = {}
    for p in newest:
        (chain,) = chains(p, lambda boss: [by_name[boss]] if boss in by_name else [])
        n = level(chain)
        manager = "Other" if n == 0 else (
            "Inactive" if chain[n - 1]["termination_date"] else chain[n - 1]["person_name"])
        result[p["person_name"]] = (n, manager)
    return result


def brute_daily(view, first, last):
    """The daily manager day by day: (name, day, level, manager, names and days of the chain)."""
    current, horizon = brute_current(view), dt.date(AS_OF.year + 1, 1, 1)
    capped = dt.date(AS_OF.year + 2, 1, 1)

    def end(p):
        return capped if p["valid_to"] >= horizon else p["valid_to"]

    def valid(p, d):
        return p["valid_from"] <= d <= end(p)

    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    found = []
    for p in view:
        met = [d for d in days if valid(p, d)] or [None]
        for d in met:
            on_day = [q for q in view if d and valid(q, d)]
            for chain in chains(p, lambda boss: [q for q in on_day if q["person_name"] == boss]):
                n = level(chain)
                manager = chain[n - 1]["person_name"] if n else current.get(
                    p["direct_report"], (0, "Inactive"))[1]
                names = [q["person_name"] for q in chain[1:]]
                found.append((p["person_name"], d, n, manager, *names, *[None] * (6 - len(names))))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def tangled(spark):
    """Gaps, overlaps, cycles, missing bosses, empty validity, and one boss of many."""
    rng = random.Random(17)
    names = [f"n{i}" for i in range(24)]
    versions = []
    for i, name in enumerate(names):
        at = day("2020-01-01") + dt.timedelta(days=rng.randrange(30))
        for _ in range(rng.randrange(1, 4)):
            length = rng.randrange(1, 40)
            versions.append({
                "person_name": name,
                "direct_report": rng.choice([names[rng.randrange(24)], "n0", "n0", "nobody", None,
                                             names[max(0, i - 1)]]),
                "job_title": rng.choice(TITLES[:3] if i % 6 == 0 else TITLES[3:]),
                "area": rng.choice(["Sales", "Care", "growth"]), "valid_from": at,
                "valid_to": rng.choice([at + dt.timedelta(days=length), OPEN_END,
                                        at - dt.timedelta(days=1)]),
                "termination_date": rng.choice([None, None, day("2020-02-20")])})
            at += dt.timedelta(days=length + rng.randrange(-5, 9))
    view = dim_view(staff(spark, *versions), AS_OF).cache()
    return view, calendar(spark, "2020-01-10", "2020-03-31")


LEVELS = [f"level_{n}_name" for n in range(2, 8)]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_daily_manager_against_brute_force(tangled, hot_rows):
    view, days = tangled
    expected = brute_daily([r.asDict() for r in view.collect()], day("2020-01-10"),
                           day("2020-03-31"))
    got = daily_manager(view, days, AS_OF, hot_rows=hot_rows)
    assert rows(got, "person_name", "dte", "manager_level", "manager", *LEVELS) == expected
    assert got.filter("(level_2_name is null) <> (level_2_dte is null)").isEmpty()


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_current_manager_against_brute_force(tangled, hot_rows):
    view, _ = tangled
    expected = brute_current([r.asDict() for r in view.collect()])
    got = current_manager(view, hot_rows=hot_rows).collect()
    assert {r["person_name"]: (r["manager_level"], r["manager"]) for r in got} == expected


def test_periods_list_the_same_days(tangled):
    view, days = tangled
    by_period = explode_days(manager_periods(view, days, AS_OF))
    assert bag(by_period.select("person_name", "dte", "manager")) == bag(
        daily_manager(view, days, AS_OF).select("person_name", "dte", "manager"))


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_roster(tangled, hot_rows):
    view, days = tangled
    got = daily_roster(view, days, AS_OF)
    people = [r.asDict() for r in view.collect()]
    boss = {p["person_name"]: p["direct_report"] for p in people if p["reverse_rank_id"] == 1}
    expected = [(p["id"], d, boss.get(p["direct_report"])) for p in people
                for d in _days(p, day("2020-01-10"), day("2020-03-31")) or [None]]
    assert rows(got, "id", "dte", "last_report") == sorted(expected, key=repr)
    assert got.filter("dte is not null and yyyy is null").isEmpty()


def test_calendar_with_holes(tangled):
    """Only days of the calendar are listed; a version without any keeps one null day."""
    view, days = tangled
    some = days.filter("dayofweek(dte) not in (1, 7) and day(dte) not between 9 and 20")
    there = {r["dte"] for r in some.collect()}
    last = max(there)
    people = [r.asDict() for r in view.collect()]
    expected = [(p["id"], d) for p in people for d in
                [d for d in _days(p, min(there), last) if d in there] or [None]]
    got = daily_roster(view, some, AS_OF)
    assert rows(got, "id", "dte") == sorted(expected, key=repr)
    assert got.filter("dte is not null and yyyy is null").isEmpty()
    whole = daily_manager(view, days, AS_OF).select("person_name", "dte", "manager", "level_2_name")
    part = daily_manager(view, some, AS_OF).select("person_name", "dte", "manager", "level_2_name")
    kept = whole.join(some.select("dte"), "dte", "left_semi").select(*whole.columns)
    assert bag(part.filter("dte is not null")) == bag(kept)


def _days(p, first, last):
    end = day("2022-01-01") if p["valid_to"] >= day("2021-01-01") else p["valid_to"]
    span = range((last - first).days + 1)
    return [d for d in (first + dt.timedelta(days=i) for i in span) if p["valid_from"] <= d <= end]


def chain_of(spark, titles):
    people = [{"person_name": f"p{i}", "direct_report": f"p{i + 1}", "job_title": t}
              for i, t in enumerate(titles)]
    return dim_view(staff(spark, *people), AS_OF), calendar(spark, "2020-01-01", "2020-01-02")


def test_chain_of_eight(spark):
    """The eighth level is out of reach, but the boss reaches it."""
    view, days = chain_of(spark, ["SDR Intern"] * 7 + ["Sales Manager"])
    now = current_manager(view).filter("person_name = 'p0'").first()
    assert (now["manager_level"], now["manager"]) == (0, "Other")
    today = daily_manager(view, days, AS_OF).filter("person_name = 'p0'").first()
    assert (today["manager_level"], today["manager"]) == (0, "p7")


def test_no_manager_and_unknown_boss(spark):
    view, days = chain_of(spark, ["SDR Intern", "SDR Intern"])
    got = daily_manager(view, days, AS_OF).filter("dte = date'2020-01-01'")
    assert rows(got, "person_name", "manager") == [("p0", "Other"), ("p1", "Inactive")]
    assert rows(current_manager(view), "person_name", "manager") == [
        ("p0", "Other"), ("p1", "Other")]


def test_vp_counts_unless_a_manager_is_below(spark):
    view, _ = chain_of(spark, ["Key Account Manager", "VP Sales", "SDR Intern"])
    got = current_manager(view)
    assert rows(got, "person_name", "manager_level") == [("p0", 0), ("p1", 1), ("p2", 0)]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_view(spark, hot_rows):
    dim = staff(
        spark,
        {"person_name": "Ana", "valid_from": day("2020-01-15"), "valid_to": day("2020-02-10"),
         "hire_date": day("2020-01-15"), "job_title": "Sales Manager", "active": 1},
        {"person_name": " Ana ", "valid_from": day("2020-02-10"), "direct_report": "Luz  Rey",
         "effective_boss": "E", "active": 0, "birth_date": day("1990-03-02")},
        {"person_name": "Luz Rey", "job_title": "Team Leader"}).withColumn(
        "person_name", F.trim("person_name"))
    got = dim_view(dim, AS_OF, hot_rows=hot_rows)
    assert tuple(got.columns) == VIEW_COLUMNS
    assert rows(got, "id", "rank_id", "reverse_rank_id", "active", "valid_from",
                "valid_from_month_start", "subteam", "subteam_active", "job_class", "age",
                "class_start", "first_role_flag") == [
        (1, 1, 2, 0, day("2020-01-15"), day("2020-01-01"), "Ana", "Inactive", "Sales Manager",
         None, day("2020-01-15"), 1),
        (2, 2, 1, 0, day("2020-02-11"), day("2020-02-11"), "Luz Rey", "E", "Intern Comercial",
         29, day("2020-02-11"), 0),
        (3, 1, 1, 1, day("2020-01-01"), day("2020-01-01"), "Luz Rey", "Luz Rey", "Industry Head",
         None, day("2020-01-01"), 1)]


def test_view_of_touching_versions_has_no_person_twice_a_day(spark):
    dim = staff(spark, *[
        {"person_name": "Ana", "valid_from": day("2020-01-01") + dt.timedelta(days=10 * v),
         "valid_to": day("2020-01-11") + dt.timedelta(days=10 * v)} for v in range(5)])
    days = calendar(spark, "2020-01-01", "2020-03-01")
    assert duplicate_keys(daily_roster(dim_view(dim, AS_OF), days, AS_OF),
                          ["person_name", "dte"]).isEmpty()


def test_uncovered_days(spark):
    df = spark.createDataFrame(
        [("a", day("2020-01-03"), day("2020-01-04")), ("a", day("2020-01-03"), day("2020-01-08")),
         ("a", day("2020-01-05"), day("2020-01-06")), ("a", day("2020-01-10"), day("2020-01-10")),
         ("b", day("2020-01-01"), day("2020-01-12")), ("c", None, None)],
        "k string, s date, e date")
    got = uncovered_days(df, ["k"], "s", "e", F.lit(day("2020-01-01")), F.lit(day("2020-01-12")))
    assert rows(got, "k", "s", "e") == [
        ("a", day("2020-01-01"), day("2020-01-02")), ("a", day("2020-01-11"), day("2020-01-12")),
        ("a", day("2020-01-09"), day("2020-01-09"))]
