"""Small tables for the tests."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from rosterline.schemas import CALENDAR, OPEN_END, SNAPSHOT, STAFF_DIM


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=repr)


def bag(df: DataFrame) -> Counter:
    """All rows with their counts, columns in order of name."""
    return Counter(tuple(map(repr, r)) for r in df.select(*sorted(df.columns)).collect())


def staff(spark: SparkSession, *versions: dict) -> DataFrame:
    """Dimension rows; what is not given takes a plain value."""
    defaults = {
        "job_title": "SDR Intern", "has_reports": 0, "area": "Sales", "cost_center": "C1",
        "country": "CO", "gender": "F", "hire_date": day("2020-01-01"), "active": 1, "dead": 0,
        "valid_from": day("2020-01-01"), "valid_to": OPEN_END, "tenure_no": 1,
        "updated_at": dt.datetime(2020, 1, 1),
    }
    data = []
    for i, version in enumerate(versions, start=1):
        merged = {"id": i, **defaults, **version}
        unknown = set(merged) - set(STAFF_DIM.names)
        assert not unknown, unknown
        data.append(tuple(merged.get(c) for c in STAFF_DIM.names))
    return spark.createDataFrame(data, STAFF_DIM)


def snapshot(spark: SparkSession, *people: dict) -> DataFrame:
    defaults = {
        "job_title": "SDR Intern", "has_reports": "No", "area": "Sales", "cost_center": "C1",
        "country": "CO", "gender": "F", "hire_date": day("2020-01-01"),
    }
    data = []
    for i, person in enumerate(people, start=1):
        merged = {"person_no": i, **defaults, **person}
        data.append(tuple(merged.get(c) for c in SNAPSHOT.names))
    return spark.createDataFrame(data, SNAPSHOT)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    data, at = [], day(first)
    while at <= day(last):
        monday = at - dt.timedelta(days=at.weekday())
        data.append((at, at.year, at.month, at.isocalendar().week, monday))
        at += dt.timedelta(days=1)
    return spark.createDataFrame(data, CALENDAR)
