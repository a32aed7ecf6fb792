"""The whole chain of jobs over the derived tables, from landing to the reports."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF, RUN_DAY, Inputs
from rosterline.operators import daily_manager, dim_view
from rosterline.plans import (ContactTables, RunOptions, StampTables, activity_analysis,
                              activity_job, contact_analysis, contact_job, dimension_job,
                              load_dim, manager_job, unify_activities, view_job)
from rosterline.operators import manager_periods
from rosterline.schemas import LEAVERS, SNAPSHOT
from rosterline.sources import land_tables, read, write
from tests.helpers import bag

FOLDER = "/root/testdata/sf0.001"


def test_chain(spark, tmp_path):
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no tables at {FOLDER}")
    t = Inputs(spark, FOLDER)
    path = {n: str(tmp_path / n) for n in (
        "tabs", "view", "calendar", "managers", "periods", "cohorts", "dispositions",
        "activities", "contacts_in", "companies", "contacts")}
    landed = str(tmp_path / "landed")
    history = f"{landed}/history.parquet"
    for tab, df in (("snapshot", t.snapshot), ("leavers", t.leavers.drop("termination_raw")),
                    ("seed", t.dim.withColumn("termination_date", F.col("termination_raw")))):
        (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{path['tabs']}/{tab}"))
    feeds = []
    for i, feed in enumerate(t.feeds):
        feeds.append(str(tmp_path / f"feed{i}"))
        write(feed, feeds[-1])
    for name, df in (("calendar", t.calendar), ("cohorts", t.cohorts), ("companies", t.companies),
                     ("dispositions", t.dispositions), ("contacts_in", t.contacts)):
        write(df, path[name])

    for run in range(2):
        names = land_tables(spark, path["tabs"], landed, seed="seed", history=history,
                            schemas={"snapshot": SNAPSHOT, "leavers": LEAVERS})
        assert ("seed" in names) == (run == 0)
        dimension_job(spark, history, f"{landed}/seed.parquet", f"{landed}/snapshot.parquet",
                      f"{landed}/leavers.parquet", RunOptions(RUN_DAY))
        if run == 0:
            first = bag(read(spark, history))
    assert bag(read(spark, history)) == first

    view_job(spark, history, path["view"], AS_OF)
    view = read(spark, path["view"])
    assert bag(view) == bag(dim_view(load_dim(read(spark, history)), AS_OF))

    manager_job(spark, path["view"], path["calendar"], path["managers"], path["periods"], AS_OF)
    assert bag(read(spark, path["managers"]).drop("yyyy")) == bag(
        daily_manager(view, t.calendar, AS_OF))

    activity_job(spark, feeds, path["view"], path["calendar"], path["cohorts"],
                 path["dispositions"], path["activities"])
    assert bag(read(spark, path["activities"])) == bag(activity_analysis(
        unify_activities(t.feeds), StampTables(t.calendar, view, t.cohorts, t.dispositions)))

    contact_job(spark, path["contacts_in"], path["companies"], path["view"], path["calendar"],
                path["cohorts"], path["periods"], path["contacts"])
    assert bag(read(spark, path["contacts"])) == bag(contact_analysis(
        t.contacts, ContactTables(t.companies, t.calendar, view, t.cohorts,
                                  manager_periods(view, t.calendar, AS_OF))))
