"""Lookups by pieces of the calendar against comparing every pair."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterline.operators import joins
from rosterline.operators import (cover, dense_keys, duplicate_days, explode_days, inside,
                                  join_overlapping, join_valid_at, overlap_periods, pieces_with,
                                  to_calendar)
from rosterline.sources import read, write
from tests.helpers import bag, calendar, day, rows

SPAN = "k string, id int, s date, e date"
ODD = [("2019-12-31", "2020-01-01"), ("2020-01-01", "2020-12-31"), ("2020-02-01", "2020-02-29"),
       ("2020-02-02", "2020-02-28"), ("2019-11-30", "2022-01-31"), ("2020-03-01", "2020-03-01"),
       ("2020-01-01", "2100-12-31"), ("2020-05-05", "2020-05-04"), ("1969-12-30", "1970-01-02"),
       ("2020-01-15", "2020-02-14"), ("2019-01-31", "2020-01-30")]


def spans(rng: random.Random, n: int, keys: str, years: int = 3):
    found = [(rng.choice(keys), i, a, a + dt.timedelta(days=rng.choice([0, 1, 30, 31, 365, 800])))
             for i in range(n)
             for a in [day("2019-06-01") + dt.timedelta(days=rng.randrange(365 * years))]]
    return found + [("a", n + i, day(s), day(e)) for i, (s, e) in enumerate(ODD)]


def test_cover_holds_each_day_once(spark):
    rng = random.Random(1)
    data = spans(rng, 60, "a")
    df = spark.createDataFrame(data, SPAN).filter("e < '2050-01-01'")
    pieces = df.select("id", F.explode(cover(F.col("s"), F.col("e"))).alias("p"))
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(day("1969-12-01")), F.lit(day("2026-12-31")))).alias("d"))
    days = days.select("d", F.explode(pieces_with(F.col("d"))).alias("p"))
    found = pieces.join(days, "p").select("id", "d")
    expected = explode_days(df, "s", "e", "d").select("id", "d").filter("d is not null")
    assert bag(found) == bag(expected)
    most = spark.createDataFrame(data, SPAN).select(
        F.size(cover(F.col("s"), F.col("e"))).alias("n"), "s", "e")
    assert all(r["n"] <= 85 + max(0, r["e"].year - r["s"].year) for r in most.collect())
    none = spark.sql("select cast(null as date) as s, date'2020-01-01' as e")
    assert none.select(F.size(cover(F.col("s"), F.col("e")))).first()[0] == 0


def facts_of(spark, rng: random.Random, n: int):
    data = [(rng.choice("aaabc") if i % 17 else None, i,
             None if i % 13 == 0 else day("2019-05-01") + dt.timedelta(days=rng.randrange(1400)))
            for i in range(n)]
    return spark.createDataFrame(data + data[:5], "k string, fact int, at date"), data + data[:5]


@pytest.mark.parametrize("dense", [3, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_versions_of_a_day(spark, dense, how):
    rng = random.Random(2)
    facts, data = facts_of(spark, rng, 200)
    versions = spans(rng, 150, "aaaab")
    found = join_valid_at(facts, spark.createDataFrame(versions, SPAN), ["k"], "at", "s", "e",
                          how, dense=dense)
    assert found.columns == ["k", "fact", "at", "id", "s", "e"]
    expected = []
    for k, fact, at in data:
        met = [v for v in versions if k == v[0] and at is not None and v[2] <= at <= v[3]]
        expected += [(k, fact, at, *v[1:]) for v in met]
        if not met and how == "left":
            expected.append((k, fact, at, None, None, None))
    assert rows(found) == sorted(expected, key=repr)


def test_hot_key_of_many_versions(spark):
    """Parts of a hot key and days of a dense one go together."""
    rng = random.Random(3)
    facts, _ = facts_of(spark, rng, 300)
    versions = spark.createDataFrame(spans(rng, 100, "ab"), SPAN)
    plain = join_valid_at(facts, versions, ["k"], "at", "s", "e")
    split = join_valid_at(facts, versions, ["k"], "at", "s", "e", hot_rows=20,
                          spread_by=["fact"], dense=5)
    assert bag(plain) == bag(split)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("full", [False, True])
def test_overlaps(spark, how, full):
    rng = random.Random(4)
    a, b = spans(rng, 60, "aab"), spans(rng, 70, "aac")
    a.append((None, 999, day("2020-01-01"), day("2020-01-02")))
    df_a = spark.createDataFrame(a, SPAN)
    df_b = spark.createDataFrame(b, "k string, id2 int, s2 date, e2 date")
    found = join_overlapping(df_a, df_b, ["k"], ("s", "e"), ("s2", "e2"), how, full, dense=8)
    plain = join_overlapping(df_a, df_b, ["k"], ("s", "e"), ("s2", "e2"), how, full)
    assert bag(found) == bag(plain)
    if how == "inner":
        def touch(x, y):
            if full:
                return x[2] <= y[3] and y[2] <= x[3]
            return y[2] <= x[2] <= y[3] or y[2] <= x[3] <= y[3]
        assert rows(found.select("id", "id2")) == sorted(
            [(x[1], y[1]) for x in a for y in b if x[0] == y[0] and touch(x, y)], key=repr)


def test_one_owner_of_many_versions_compares_no_more_than_it_matches(spark):
    """4,000 facts and 4,000 versions of one owner: 16 million pairs if all were compared."""
    first = F.lit(day("2000-01-01"))
    versions = spark.range(4000).select(
        F.lit("a").alias("k"), "id", F.date_add(first, (F.col("id") * 2).cast("int")).alias("s"),
        F.date_add(first, (F.col("id") * 2 + 2).cast("int")).alias("e"))
    facts = spark.range(4000).select(
        F.lit("a").alias("k"), F.date_add(first, (F.col("id") * 2 + 2).cast("int")).alias("at"))
    assert dense_keys(versions, ["k"], 128).count() == 1
    joined = join_valid_at(facts, versions, ["k"], "at", "s", "e")
    assert joined.count() == 7999
    plan = joined._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    # every join of rows with rows is by the day or by a piece of the calendar, not by the owner
    assert joins and all("_node" in j or "_piece" in j or "Semi" in j or "Anti" in j
                         or "_dense" in plan for j in joins)


def test_overlap_periods(spark):
    data = [("a", day(s), day(e)) for s, e in (
        ("2020-01-01", "2020-01-10"), ("2020-01-05", "2020-01-20"), ("2020-01-05", "2020-01-06"),
        ("2020-01-11", "2020-01-11"), ("2020-02-01", "2020-02-02"), ("2020-02-03", "2020-02-04"),
        ("2020-03-05", "2020-03-01"))]
    data += [(None, day("2020-01-01"), day("2020-01-02"))] * 2 + [("b", None, day("2020-01-01"))]
    df = spark.createDataFrame(data, "k string, s date, e date")
    assert rows(overlap_periods(df, ["k"], "s", "e")) == sorted([
        ("a", day("2020-01-05"), day("2020-01-06"), 3),
        ("a", day("2020-01-07"), day("2020-01-11"), 2),
        (None, day("2020-01-01"), day("2020-01-02"), 2)], key=repr)


def test_duplicate_days_against_listing_all(spark):
    rng = random.Random(7)
    df = spark.createDataFrame(spans(rng, 80, "abc"), SPAN)
    days = calendar(spark, "2019-08-01", "2021-12-31").filter("dayofweek(dte) not in (1, 7)")
    days = days.filter("dte not between '2020-04-03' and '2020-06-09'").unionByName(days.limit(3))
    found = duplicate_days(df, ["k"], "s", "e", days)
    listed = df.join(days.select("dte").distinct(), F.col("dte").between(F.col("s"), F.col("e")),
                     "left")
    expected = listed.groupBy("k", "dte").agg(F.count(F.lit(1)).alias("row_count")).filter(
        "row_count > 1")
    assert bag(found) == bag(expected)


def test_calendar_days_within_intervals(spark):
    rng = random.Random(8)
    df = spark.createDataFrame(spans(rng, 100, "a") + [("a", 998, None, day("2020-01-01")),
                                                       ("a", 999, day("2020-01-01"), None)], SPAN)
    days = calendar(spark, "2019-08-01", "2021-06-30").filter("dayofweek(dte) between 2 and 5")
    known = sorted(r["dte"] for r in days.collect())
    found = to_calendar(df, F.col("s"), F.col("e"), days)
    for r in found.collect():
        inner = [d for d in known if r["s"] and r["e"] and r["s"] <= d <= r["e"]]
        expected = (inner[0], inner[-1]) if inner else (None, None)
        assert (r["first_day"], r["last_day"]) == expected, r
    empty = to_calendar(df, F.col("s"), F.col("e"), days.limit(0))
    assert empty.filter("first_day is not null or last_day is not null").isEmpty()


def test_listed_pieces_are_not_broadcast(spark, tmp_path):
    """The planner takes them for as large as the files they are listed from."""
    rng = random.Random(9)
    write(facts_of(spark, rng, 50)[0], str(tmp_path / "points"))
    write(spark.createDataFrame(spans(rng, 50, "ab"), SPAN), str(tmp_path / "ranges"))
    points, ranges = (read(spark, str(tmp_path / n)) for n in ("points", "ranges"))
    plan = inside(points, ranges, ["k"], "at", "s", "e")._jdf.queryExecution().executedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join" in line]
    assert joins and not any("Broadcast" in j for j in joins)


def test_versions_of_keys_without_a_fact_are_not_listed(spark, monkeypatch):
    """Ten owners of 200 versions each, facts of one: only its versions are cut into pieces."""
    listed = []

    def inside_seen(points, ranges, *args):
        listed.append(ranges.count())
        return inside(points, ranges, *args)

    monkeypatch.setattr(joins, "inside", inside_seen)
    first = F.lit(day("2000-01-01"))
    at = (F.col("id") % 200).cast("int")
    versions = spark.range(2000).select(
        F.floor(F.col("id") / 200).alias("k"), "id", F.date_add(first, at).alias("s"),
        F.date_add(first, at + 20).alias("e"))
    facts = spark.range(20).select(F.lit(3).cast("long").alias("k"), F.date_add(
        first, (F.col("id") % 2 * 300 + 10).cast("int")).alias("at"))
    joined = join_valid_at(facts, versions, ["k"], "at", "s", "e")
    assert joined.count() == 10 + 10 * 11 and listed == [200]


def test_pieces_of_a_short_and_a_long_range_are_few(spark):
    df = spark.createDataFrame([(day("2020-01-01"), day("2020-02-09")),
                                (day("1995-05-05"), day("2100-12-31"))], "s date, e date")
    assert all(r["n"] <= 60 for r in df.select(
        F.size(cover(F.col("s"), F.col("e"))).alias("n")).collect())
