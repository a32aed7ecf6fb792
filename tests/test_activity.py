from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterline.operators import (dim_view, join_overlapping, join_range, join_valid_at,
                                  manager_periods, tenure_metrics)
from rosterline.plans import (ContactTables, StampTables, TenureOptions, activity_analysis,
                              adjusted_date, contact_analysis, stamp_activities,
                              unify_activities)
from rosterline.schemas import ACTIVITY, COHORT, COMPANY, CONTACT, DISPOSITION
from tests.helpers import bag, calendar, day, rows, staff

AS_OF = day("2020-06-01")


def test_metrics_at_their_limits(spark):
    cases = [  # event, start, kind -> days, weeks, months, actual weeks, actual months
        (("2020-03-16", "2020-03-15", "CALL"), (2, 2, 1, 2, 1)),
        (("2020-03-16", "2020-03-16", "CALL"), (1, 1, 0, 1, 0)),
        (("2020-06-07", "2020-03-16", "CALL"), (84, 12, 3, 12, 3)),
        (("2020-06-08", "2020-03-16", "CALL"), (85, 13, 3, 13, 3)),
        (("2020-09-01", "2020-03-01", "CALL"), (185, 13, 7, 28, 7)),
        (("2020-11-01", "2020-03-01", "CALL"), (246, 13, 7, 36, 9)),
        (("2020-03-16", "2020-03-16", "MEETING"), (1, 2, 0, 2, 0)),
        (("2020-03-15", "2020-03-16", "MEETING"), (0, 2, 0, 2, 0)),
        (("2020-03-14", "2020-03-16", "MEETING"), (-1, 0, 0, 0, 0)),
        (("2020-03-24", "2020-03-16", "MEETING"), (9, 2, 0, 2, 0)),
        ((None, "2020-03-16", "CALL"), (None, 13, 7, None, None)),
        (("2020-03-16", None, "CALL"), (None, 13, 7, None, None)),
    ]
    df = spark.createDataFrame(
        [(i, e and day(e), s and day(s), k) for i, ((e, s, k), _) in enumerate(cases)],
        "i int, event date, start date, kind string")
    got = tenure_metrics(df, "event", "start", "kind", meeting_rule=True).orderBy("i").select(
        "days_since_entry", "weeks_since_entry", "months_since_entry",
        "actual_weeks_since_entry", "actual_months_since_entry")
    assert [tuple(r) for r in got.collect()] == [expected for _, expected in cases]


def test_metrics_by_days_and_rounded(spark):
    df = spark.createDataFrame([(day("2020-03-20"), day("2020-03-01")),
                                (day("2020-03-10"), day("2020-02-20"))], "e date, s date")
    got = tenure_metrics(df, "e", "s", week_mode="days", month_mode="rounded").collect()
    assert [(r["weeks_since_entry"], r["actual_weeks_since_entry"], r["months_since_entry"])
            for r in got] == [(13, 20, 2), (13, 20, 1)]


def test_metrics_refuse_unknown_modes(spark):
    df = spark.createDataFrame([(day("2020-03-20"), day("2020-03-01"))], "e date, s date")
    for wrong in ({"week_mode": "x"}, {"month_mode": "x"}, {"meeting_rule": True}):
        with pytest.raises(ValueError):
            tenure_metrics(df, "e", "s", **wrong)


def intervals(spark):
    return spark.createDataFrame(
        [("o", "v1", day("2020-01-01"), day("2020-01-10")),
         ("o", "v2", day("2020-01-10"), day("2020-01-20"))],
        "owner string, version string, valid_from date, valid_to date")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_boundary_day_meets_both_versions(spark, hot_rows):
    facts = spark.createDataFrame(
        [(1, "o", day("2020-01-10")), (2, "o", day("2020-01-11")), (3, "o", day("2020-02-01")),
         (4, None, day("2020-01-05")), (5, "o", None)], "fact int, owner string, at date")
    got = join_valid_at(facts, intervals(spark), ["owner"], "at", hot_rows=hot_rows)
    assert rows(got, "fact", "version") == [
        (1, "v1"), (1, "v2"), (2, "v2"), (3, None), (4, None), (5, None)]
    inner = join_valid_at(facts, intervals(spark), ["owner"], "at", how="inner")
    assert rows(inner, "fact") == [(1,), (1,), (2,)]


def test_overlap_misses_containment(spark):
    a = spark.createDataFrame([("k", day("2020-01-01"), day("2020-01-30"))],
                              "k string, s date, e date")
    b = spark.createDataFrame([("k", day("2020-01-10"), day("2020-01-20"))],
                              "k string, s2 date, e2 date")
    days = (("s", "e"), ("s2", "e2"))
    assert join_overlapping(a, b, ["k"], *days, how="inner").isEmpty()
    assert join_overlapping(a, b, ["k"], *days, how="inner", full_overlap=True).count() == 1
    swapped = join_overlapping(b, a, ["k"], ("s2", "e2"), ("s", "e"), how="inner")
    assert swapped.count() == 1


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_range_join_against_brute_force(spark, hot_rows):
    rng = random.Random(4)
    zero = day("2020-01-01")
    points = [(i, zero + dt.timedelta(days=rng.randrange(200)) if i % 9 else None)
              for i in range(150)]
    spans = [(j, zero + dt.timedelta(days=s), zero + dt.timedelta(days=s + rng.randrange(-3, 90)))
             for j, s in enumerate(rng.randrange(200) for _ in range(25))]
    expected = []
    for i, at in points:
        met = [j for j, s, e in spans if at and s <= at <= e]
        expected += [(i, j) for j in met or [None]]
    got = join_range(spark.createDataFrame(points, "i int, at date"),
                     spark.createDataFrame(spans, "j int, s date, e date"), "at", "s", "e",
                     hot_rows=hot_rows)
    assert rows(got, "i", "j") == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def crm(spark):
    rng = random.Random(8)
    zero = day("2020-01-01")
    people = []
    for i in range(12):
        at = zero + dt.timedelta(days=rng.randrange(20))
        for v in range(rng.randrange(1, 4)):
            people.append({
                "person_name": f"n{i}", "direct_report": f"n{i // 2}", "owner_id": i,
                "hire_date": zero + dt.timedelta(days=i * 5), "valid_from": at,
                "job_title": rng.choice(["Sales Manager", "SDR Intern"]),
                "valid_to": at + dt.timedelta(days=30), "tenure_no": 1})
            at += dt.timedelta(days=30)
    view = dim_view(staff(spark, *people), AS_OF).cache()
    cohorts = spark.createDataFrame(
        [("early", day("2020-01-01"), day("2020-01-20")),
         ("late", day("2020-02-01"), day("2020-03-01"))], COHORT)
    tables = StampTables(calendar(spark, "2020-01-05", "2020-04-30"), view, cohorts,
                         spark.createDataFrame([("1", "Spoke")], DISPOSITION))
    data = []
    for i in range(300):
        at = zero + dt.timedelta(days=rng.randrange(140))
        kind = rng.choice(["CALL", "EMAIL", "MEETING", "NOTE", "TASK"])
        data.append((i, dt.datetime.combine(at - dt.timedelta(days=rng.randrange(30)),
                                            dt.time(9, 30)),
                     3 if i % 3 == 0 else rng.choice([None, *range(14)]),
                     dt.datetime.combine(at, dt.time(22, 15)), kind, "DONE",
                     rng.choice(["1", "2", None]), i, None, i % 5, "c"))
    return tables, spark.createDataFrame(data, ACTIVITY)


def feeds_of(activities):
    lacks = {"CALL": ["meeting_outcome"], "EMAIL": ["disposition_id"], "MEETING": [],
             "NOTE": ["call_duration"], "TASK": ["contact_ids", "status"]}
    feeds = []
    for kind, dropped in lacks.items():
        part = activities.filter(F.col("activity_type") == kind).drop(*dropped)
        feeds.append(part.toDF(*[c if c in ("activity_id", "created_at") else f"properties.{c}"
                                 for c in part.columns]))
    return feeds


def test_feeds_are_unified(crm):
    _, activities = crm
    got = unify_activities(feeds_of(activities))
    assert sorted(got.columns) == sorted([*activities.columns, "activity_date"])
    assert got.count() == activities.count()
    assert got.filter("activity_type = 'TASK' and status is not null").isEmpty()
    assert got.filter("activity_type = 'CALL' and status is null").isEmpty()
    assert got.filter("activity_date <> cast(activity_at as date)").isEmpty()


def brute_stamps(tables, facts, column):
    view = [r.asDict() for r in tables.staff.collect()]
    known = {r["dte"] for r in tables.calendar.collect()}
    cohorts = tables.cohorts.collect()
    found = []
    for f in facts:
        at = f[column].date()
        dte = at if at in known else None
        met = [p for p in view if dte and p["owner_id"] == f["owner_id"]
               and p["valid_from"] <= dte <= p["valid_to"]] or [None]
        for p in met:
            cohort = "Unidentified"
            for c in cohorts:
                if p and c["start_date"] <= p["hire_date"] <= c["end_date"]:
                    cohort = c["name"]
            found.append((f["activity_id"], dte, p and p["person_name"],
                          p and p["subteam"], cohort,
                          (dte - p["hire_date"]).days + 1 if p else None))
    return sorted(found, key=repr)


SHOWN = ("dte", "person_name", "subteam", "cohort", "days_since_entry")


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_stamps_against_brute_force(crm, hot_rows):
    tables, activities = crm
    facts = unify_activities(feeds_of(activities))
    got = stamp_activities(facts, tables, hot_rows=hot_rows)
    assert rows(got, "activity_id", *SHOWN) == brute_stamps(
        tables, activities.collect(), "activity_at")


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_both_stamps_side_by_side(crm, hot_rows):
    """The same as joining two separately stamped tables on the activity."""
    tables, activities = crm
    facts = unify_activities(feeds_of(activities))
    options = TenureOptions("days", "rounded", False)
    got = activity_analysis(facts, tables, options=options, hot_rows=hot_rows)
    own = stamp_activities(facts, tables, options=options)
    created = stamp_activities(facts, tables, "created_date", options)
    stamped = [c for c in own.columns if f"creation_{c}" in got.columns]
    assert len(stamped) == 17
    created = created.select("activity_id", *[
        F.col(c).alias(f"creation_{c}") for c in stamped])
    assert bag(got) == bag(own.join(created, "activity_id", "left"))
    assert rows(got, "activity_id", *[f"creation_{c}" for c in SHOWN]) == brute_stamps(
        tables, activities.collect(), "created_at")


def test_activities_are_shuffled_once(crm, spark):
    """With hot owners and no broadcast, both stamps use one shuffle of the activities."""
    tables, activities = crm
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        small = StampTables(F.broadcast(tables.calendar), tables.staff, tables.cohorts,
                            F.broadcast(tables.dispositions))
        facts = activities.withColumn("activity_date", F.col("activity_at").cast("date"))
        df = activity_analysis(facts, small, hot_rows=10)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    moved = [line for line in plan.splitlines()
             if "hashpartitioning(owner_id" in line and "_part" in line]
    assert len(moved) == 1, plan


def test_stamp_count_equals_activity_count(crm):
    tables, activities = crm
    got = stamp_activities(unify_activities(feeds_of(activities)), tables)
    assert got.count() == activities.count()


def test_adjusted_dates(spark):
    days = calendar(spark, "2020-01-01", "2020-02-29")
    cases = [  # created, hired -> adjusted; 2020-01-05 was a Sunday
        ("2020-01-06", "2020-01-06", "2020-01-13"),   # week 1
        ("2020-01-13", "2020-01-06", "2020-01-13"),   # week 2: stays
        ("2020-01-20", "2020-01-06", "2020-02-03"),   # week 3
        ("2020-01-27", "2020-01-06", "2020-02-03"),   # week 4
        ("2020-02-03", "2020-01-06", "2020-02-03"),   # week 5
        ("2020-02-26", "2020-02-24", None),           # moved beyond the calendar
        ("2020-01-01", "2019-12-01", None),           # a day earlier is before it
        ("2020-01-08", None, "2020-01-08"), (None, "2020-01-06", None)]
    df = spark.createDataFrame([(i, c and day(c), h and day(h))
                                for i, (c, h, _) in enumerate(cases)],
                               "i int, created date, hired date")
    got = adjusted_date(df, "created", "hired", days).orderBy("i").select("adj_dte").collect()
    assert [r[0] for r in got] == [a and day(a) for _, _, a in cases]


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_contacts(spark, crm, hot_rows):
    tables, activities = crm
    contacts = activities.select(
        F.col("activity_id").alias("contact_id"),
        F.when(F.col("activity_id") % 2 == 0, 1).otherwise(F.col("activity_id")).cast("long")
        .alias("company_id"), "owner_id", F.col("activity_at").alias("created_at"),
        F.when(F.col("activity_id") % 4 > 0,
               F.date_add(F.col("activity_at").cast("date"), (F.col("activity_id") % 8).cast("int"))
               .cast("timestamp")).alias("last_contacted_at"),
        F.lit("s").alias("source_label"), F.lit("l").alias("lead_label"))
    contacts = spark.createDataFrame(contacts.collect(), CONTACT)
    companies = spark.createDataFrame([(1, 5), (3, None), (5, 9)], COMPANY)
    periods = manager_periods(tables.staff, tables.calendar, AS_OF).cache()
    got = contact_analysis(contacts, ContactTables(
        companies, tables.calendar, tables.staff, tables.cohorts, periods), hot_rows)
    stamps = {s[0]: s for s in brute_stamps(tables, activities.collect(), "activity_at")}
    managers = {}
    for p in periods.collect():
        at = p["first_day"]
        while at and at <= p["last_day"]:
            managers[p["person_name"], at] = p["manager"]
            at += dt.timedelta(days=1)
    found = got.collect()
    assert len(found) == contacts.count()
    for r in found:
        _, dte, name, subteam, cohort, days = stamps[r["contact_id"]]
        assert (r["original_dte"], r["person_name"], r["subteam"], r["creation_cohort"],
                r["original_days_since_entry"]) == (dte, name, subteam, cohort, days)
        assert r["manager"] == managers.get((name, r["dte"]))
        assert r["has_row_tag"] == int(r["contact_id"] % 2 == 0 or r["contact_id"] in (1, 5))
        soon = r["contact_id"] % 4 > 0 and dte is not None and r["contact_id"] % 8 <= 5
        assert r["contacted_soon"] == int(soon)
    assert any(r["manager"] for r in found) and any(r["dte"] is None for r in found)
