"""Reports by year of which only the changed years are written again."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from rosterline.operators import daily_manager, dim_view, periods_to_days
from rosterline.plans import (StampTables, activity_analysis, activity_job, changed_rows,
                              cut_to_years, manager_job, touched_years, unify_activities,
                              view_job)
from rosterline.plans.jobs import days_by_year
from rosterline.schemas import COHORT, DISPOSITION
from rosterline.sources import read, stage_version, write, write_partitions, write_version
from tests.helpers import bag, calendar, day, rows, staff

AS_OF = day("2021-06-30")
PERIOD = "k string, s date, e date"


def files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_changed_rows(spark):
    before = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", None), ("c", 4)], "k string, v int")
    assert rows(changed_rows(before, after)) == [("a", 1), ("c", 3), ("c", 4)]
    assert changed_rows(after, after).isEmpty()


def test_years_of_periods(spark):
    days = calendar(spark, "2019-03-01", "2022-02-01")
    df = spark.createDataFrame([
        ("a", day("2010-01-01"), day("2019-05-01")), ("b", day("2021-12-31"), day("2022-01-01")),
        ("c", day("2023-01-01"), day("2100-12-31")), ("d", None, None)], PERIOD)
    assert touched_years(df, "s", "e", days) == [None, 2019, 2021, 2022]
    assert touched_years(df.filter("k = 'c'"), "s", "e", days) == []
    assert rows(cut_to_years(df, "s", "e", [2019, 2022])) == [
        ("a", day("2019-01-01"), day("2019-05-01")), ("b", day("2022-01-01"), day("2022-01-01"))]
    assert rows(cut_to_years(df, "s", "e", [None])) == [("d", None, None)]


def test_only_named_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2021), (4, None)], "v int, y int")
    write(df, path, ["y"])
    before = files(path)
    new = spark.createDataFrame([(20, 2020), (21, 2020)], "v int, y int")
    write_partitions(new, path, "y", [2020, None, 2025], ["v"])
    assert rows(read(spark, path)) == [(1, 2019), (20, 2020), (21, 2020), (3, 2021)]
    assert {f for f in before if "y=2019" in f or "y=2021" in f} <= files(path)
    write_partitions(new.limit(0), path, "y", [])
    write_partitions(new.limit(0), path, "y", [2021])
    assert rows(read(spark, path)) == [(1, 2019), (20, 2020), (21, 2020)]


def people(spark, title: str, boss: str = "Ann"):
    return staff(
        spark, {"person_name": "Ann", "job_title": "Sales Manager", "owner_id": 1,
                "hire_date": day("2018-01-01"), "valid_from": day("2018-01-01")},
        {"person_name": "Bob", "direct_report": "Ann", "owner_id": 2,
         "hire_date": day("2018-01-01"), "valid_from": day("2018-01-01"),
         "valid_to": day("2020-04-30"), "dead": 1},
        {"person_name": "Bob", "direct_report": boss, "owner_id": 2, "job_title": title,
         "hire_date": day("2018-01-01"), "valid_from": day("2020-04-30"),
         "valid_to": day("2020-08-01")},
        {"person_name": "Old", "owner_id": 3, "valid_from": day("2001-01-01"),
         "valid_to": day("2001-02-01")})


def test_managers_by_year(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("dim", "view", "calendar", "out", "periods")}
    days = calendar(spark, "2018-06-01", "2021-12-31")
    write(days, path["calendar"])

    def run(dim):
        write_version(dim, path["dim"])
        view_job(spark, path["dim"], path["view"], AS_OF)
        return manager_job(spark, path["view"], path["calendar"], path["out"], path["periods"],
                           AS_OF)

    def expected(dim):
        return bag(daily_manager(dim_view(dim, AS_OF), days, AS_OF))

    first = people(spark, "SDR Intern")
    assert run(first) == [None, 2018, 2019, 2020, 2021]
    before = files(path["out"])
    assert run(first) == [] and files(path["out"]) == before  # a repeat changes nothing
    second = people(spark, "VP Sales", boss="Nobody")
    # a run that stops before its commit leaves the years to the next one
    write_version(second, path["dim"])
    view_job(spark, path["dim"], path["view"], AS_OF)
    stage_version(read(spark, path["view"]).limit(1), path["periods"])
    assert run(second) == [2020]
    assert {f for f in before if "yyyy=2020" not in f} <= files(path["out"])
    assert not {f for f in before if "yyyy=2020" in f} & files(path["out"])
    assert bag(read(spark, path["out"]).drop("yyyy")) == expected(second)


def test_days_are_neither_shuffled_nor_sorted(spark, tmp_path):
    """Periods are; days are listed from them in the tasks that write them."""
    data = [(f"p{i:02}", None if i == 7 else day("2019-06-01"), None if i == 7 else
             day("2021-03-01"), "Ann") for i in range(20)] * 2
    periods = spark.createDataFrame(
        data, "person_name string, first_day date, last_day date, level_2_name string")
    days = calendar(spark, "2019-01-01", "2021-12-31").filter("dayofweek(dte) <> 1")
    path, years = str(tmp_path / "t"), [None, 2019, 2020, 2021]
    plain = periods_to_days(periods, days).withColumn("yyyy", F.year("dte"))
    write(plain, path, ["yyyy"], ["person_name", "dte"])
    assert bag(read(spark, path)) == bag(plain)
    for some in (years, [2020]):
        listed = days_by_year(periods, days, some, rows_per_file=5000)
        write_partitions(listed, path, "yyyy", some, placed=True)
        assert bag(read(spark, path)) == bag(plain)
        plan = listed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate") < plan.index("Repartition")  # the days come after
    listed = days_by_year(periods, days, years, rows_per_file=5000)
    assert listed.rdd.getNumPartitions() == 5
    write(listed, path, ["yyyy"], placed=True)
    assert bag(read(spark, path)) == bag(plain)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    for f in glob.glob(f"{path}/yyyy=2020/*.parquet"):
        names = [r["person_name"] for r in spark.read.parquet(f).collect()]
        assert names == sorted(names)


def test_activities_by_year(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("dim", "view", "calendar", "out", "cohorts", "calls",
                                           "dispositions")}
    days = calendar(spark, "2018-06-01", "2021-12-31")
    columns = ("activity_id long, created_at timestamp, `properties.owner_id` long, "
               "`properties.activity_at` timestamp, `properties.activity_type` string, "
               "`properties.status` string, `properties.disposition_id` string, "
               "`properties.call_duration` int, `properties.meeting_outcome` string, "
               "`properties.company_id` long, `properties.contact_ids` string")
    dates = [("2018-07-01", "2018-06-30"), ("2019-05-05", "2019-05-05"),
             ("2020-06-06", "2020-06-01"), ("2021-01-05", "2020-07-01"),
             ("2021-03-01", "2021-03-01"), ("2030-01-01", "2020-06-06"), (None, "2018-07-01")]
    import datetime as dt

    def moment(text):
        return None if text is None else dt.datetime.fromisoformat(text)

    data = [(i, moment(c), 2, moment(a), "CALL", "F", "F", 5, None, 9, "c")
            for i, (a, c) in enumerate(dates)]
    calls = spark.createDataFrame(data, columns)
    cohorts, dispositions = (spark.createDataFrame([], s) for s in (COHORT, DISPOSITION))
    for name, df in (("calendar", days), ("cohorts", cohorts), ("calls", calls),
                     ("dispositions", dispositions)):
        write(df, path[name])

    def run(dim, since):
        write_version(dim, path["dim"])
        view_job(spark, path["dim"], path["view"], AS_OF)
        return activity_job(spark, [path["calls"]], path["view"], path["calendar"],
                            path["cohorts"], path["dispositions"], path["out"], since=since)

    first, second = people(spark, "SDR Intern"), people(spark, "VP Sales", boss="Nobody")
    assert run(first, None) == (1, [None, 2018, 2019, 2020, 2021])
    before = files(path["out"])
    assert run(first, 1) == (2, []) and files(path["out"]) == before
    # 2020 changed: done in it, or created in it and done in another year or on no known day
    assert run(second, 2) == (3, [None, 2020, 2021])
    assert {f for f in before if "yyyy=2018" in f or "yyyy=2019" in f} <= files(path["out"])
    tables = StampTables(days, dim_view(second, AS_OF), cohorts, dispositions)
    expected = activity_analysis(unify_activities([calls]), tables)
    assert bag(read(spark, path["out"])) == bag(expected)
    assert read(spark, path["out"]).filter(F.col("subteam") == "Nobody").count() == 1
