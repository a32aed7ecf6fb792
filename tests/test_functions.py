from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.functions import (age, classify, first_match, fold_accents, fractional_months,
                                  is_leader, month_diff, name_key, null_if, weeks_between)
from tests.helpers import day


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,expected", [
    (" a   b ", "a  b"), ("  Ana  Paz ", "Ana Paz"), ("", ""), (None, None)])
def test_name_key_replaces_double_blanks_once(spark, text, expected):
    assert one(spark, name_key(F.lit(text).cast("string"))) == expected


def test_fold_accents_and_null_if(spark):
    assert one(spark, fold_accents(F.lit("Atención médica"))) == "Atencion medica"
    assert one(spark, null_if(F.lit("NULL"), "NULL")) is None
    assert one(spark, null_if(F.lit("2020-01-01"), "NULL")) == "2020-01-01"


# 2021-03-13 was a Saturday.
@pytest.mark.parametrize("a,b,sunday,monday", [
    ("2021-03-13", "2021-03-14", 1, 0), ("2021-03-14", "2021-03-15", 0, 1),
    ("2021-03-15", "2021-03-14", 0, -1), ("1969-12-27", "1970-01-05", 2, 2),
    ("1960-01-01", "1960-01-01", 0, 0)])
def test_week_boundaries(spark, a, b, sunday, monday):
    a, b = F.lit(day(a)), F.lit(day(b))
    assert one(spark, weeks_between(a, b, "sun")) == sunday
    assert one(spark, weeks_between(a, b, "mon")) == monday


def test_weeks_against_python(spark):
    days = spark.range(4000).select(F.date_add(F.lit(day("1966-01-01")), F.col("id").cast("int"))
                                    .alias("d"))
    start = dt.date(1969, 12, 31)
    found = days.select("d", weeks_between(F.lit(start), F.col("d"), "mon").alias("mon"),
                        weeks_between(F.lit(start), F.col("d"), "sun").alias("sun")).collect()

    def monday(d):
        return d - dt.timedelta(days=d.weekday())

    def sunday(d):
        return d - dt.timedelta(days=(d.weekday() + 1) % 7)

    for r in found:
        assert r["mon"] == (monday(r["d"]) - monday(start)).days // 7
        assert r["sun"] == (sunday(r["d"]) - sunday(start)).days // 7


def test_weeks_rejects_other_days():
    with pytest.raises(ValueError):
        weeks_between(None, None, "tue")


@pytest.mark.parametrize("a,b,boundaries,rounded", [
    ("2020-01-31", "2020-02-01", 1, 0), ("2020-01-01", "2020-03-20", 2, 3),
    ("2020-01-31", "2020-02-29", 1, 1), ("2020-05-10", "2020-05-01", 0, 0)])
def test_months(spark, a, b, boundaries, rounded):
    a, b = F.lit(day(a)), F.lit(day(b))
    assert one(spark, month_diff(a, b)) == boundaries
    assert one(spark, fractional_months(a, b)) == rounded


@pytest.mark.parametrize("birth,at,years", [
    ("2020-05-01", "2021-05-01", 1), ("2020-05-02", "2021-05-01", 0),
    ("2020-02-29", "2021-02-28", 1), ("1960-12-31", "2020-12-30", 59)])
def test_age_is_in_whole_years(spark, birth, at, years):
    assert one(spark, age(F.lit(day(birth)), F.lit(day(at)))) == years


# One row per rule, in the rules' order, and near misses.
ROLES = [
    ("Chief Revenue Officer", "Sales", "CSO"),
    ("VP Sales", "sales LATAM", "Sales VP"),
    ("Sales Country Manager", "Sales", "Sales Manager"),
    ("Manager of Sales", "Sales", "Business Developer"),
    ("Head of Expansions", "Customer", "Expansions Head"),
    ("Expansions specialist", "Growth", "Expansions Expert"),
    ("Senior Team Leader", "Sales", "Sr Industry Head"),
    ("Senior SDR Leader", "Sales", "Sr Business Developer"),
    ("Industry Head", "Sales", "Industry Head"),
    ("Sales Representative", "Sales", "Sales Developer Representative"),
    ("Representative", "SDR", "Sales Developer Representative"),
    ("Representative", "growth", "Sales Developer Representative"),
    ("Head of SDR", "Inbound", "SDR Head"),
    ("Senior Executive", "Sales", "Sr Business Developer"),
    ("Junior Executive", "Sales", "Jr Business Developer"),
    ("Intern", "Sales", "Intern Comercial"),
    ("Executive", "Sales", "Business Developer"),
    ("VP Success", "Customer", "Customer Success VP"),
    ("Customer Success Senior Manager", "customer", "Customer Success Sr Manager"),
    ("Student Success Manager", "Customer", "Student Success Manager"),
    ("Customer Experience Manager", "Customer", "Customer Experience Manager"),
    ("Customer Sucess Manager", "Customer", "Customer Success Manager"),
    ("Head of KAMs", "Customer", "KAMs Head"),
    ("Account Head", "Customer", "KAMs Head"),
    ("Expansion Head", "Customer", "Expansions Head"),
    ("Head of Care", "Customer", "Customer Success Head"),
    ("Sr Key Account", "Customer", "Sr KAM"),
    ("Account Manager", "Customer", "KAM"),
    ("Analyst", "Customer", "Other"),
    ("Analyst", "Finance", "Other"),
    (None, "Finance", "Other"),
]


def test_every_role(spark):
    data = [(t, a, day("2100-12-31")) for t, a, _ in ROLES]
    df = spark.createDataFrame(data, "job_title string, area string, valid_to date")
    found = [r[0] for r in df.select(classify()).collect()]
    assert found == [label for _, _, label in ROLES]


def test_representatives_before_the_change(spark):
    df = spark.createDataFrame(
        [("Lead Representative", "Sales", day("2021-02-28")),
         ("Lead Representative", "Sales", day("2021-03-01")),
         ("Representative", "Sales", day("2021-02-28"))],
        "job_title string, area string, valid_to date")
    assert [r[0] for r in df.select(classify()).collect()] == [
        "Sales Developer Representative Lead", "Sales Developer Representative",
        "Business Developer"]


def test_leaders(spark):
    titles = {"Team Leader": True, "Head": True, "Sales Manager": True,
              "Key Account Manager": False, "Key Head": True, "Analyst": False}
    df = spark.createDataFrame([(t,) for t in titles], "job_title string")
    assert [r[0] for r in df.select(is_leader()).collect()] == list(titles.values())


def test_first_match_without_branches(spark):
    assert one(spark, first_match([], F.lit(3))) == 3
