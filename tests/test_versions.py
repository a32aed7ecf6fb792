"""Tables with versions: what a reader sees when runs end early or meet."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rosterline.plans import RunOptions, dimension_job, jobs
from rosterline.schemas import LEAVERS
from rosterline.sources import (CommitConflict, commit, exists, land_tables, latest, new_version,
                                read, read_first, read_version, version_path, versions, write,
                                write_version)
from tests.helpers import bag, day, rows, snapshot, staff


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert latest(spark, path) is None and not exists(spark, path)
    for i in range(4):
        write_version(numbers(spark, i), path)
        assert rows(read(spark, path)) == [(i,)]
    assert [v.number for v in versions(spark, path)] == [3, 4]
    assert rows(read_version(spark, path, 3)) == [(2,)]
    assert len(os.listdir(f"{path}/_versions")) == 2
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 1)


def test_table_that_reads_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write(numbers(spark, 1, 2), path)  # plain files, from before
    write_version(read(spark, path).select((F.col("n") * 10).alias("n")), path)
    assert rows(read(spark, path)) == [(10,), (20,)]
    write_version(read(spark, path).filter("n > 10").withColumn("p", F.lit(1)), path,
                  partition_by=["p"])
    assert [tuple(r) for r in read(spark, path).collect()] == [(20, 1)]


def test_run_that_stops_before_its_commit(spark, tmp_path):
    path, seed = str(tmp_path / "t"), str(tmp_path / "seed")
    write(numbers(spark, 7), seed)
    first = new_version(spark, path)
    numbers(spark, 1).write.parquet(version_path(path, first))
    assert not exists(spark, path)  # nothing was committed, so the seed is right
    assert rows(read_first(spark, [path, seed])) == [(7,)]
    write_version(numbers(spark, 2), path)
    lost = new_version(spark, path)
    numbers(spark, 3).write.parquet(version_path(path, lost))
    assert rows(read_first(spark, [path, seed])) == [(2,)]
    assert write_version(numbers(spark, 4), path).number == 2
    assert lost.folder not in os.listdir(f"{path}/_versions")
    assert first.folder not in os.listdir(f"{path}/_versions")


def test_marker_cut_short(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(numbers(spark, 1), path)
    for i, text in enumerate(["", '{"fold', "[]", '{"other": 1}'], start=2):
        (tmp_path / "t" / "_commits" / f"{i:010}").write_text(text)
    (tmp_path / "t" / "_commits" / "note").write_text("no marker")
    assert rows(read(spark, path)) == [(1,)]
    assert write_version(numbers(spark, 2), path).number == 6
    assert rows(read(spark, path)) == [(2,)]
    assert [v.number for v in versions(spark, path)] == [1, 6]


def test_two_runs_at_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(numbers(spark, 1), path)
    one, other = new_version(spark, path), new_version(spark, path)
    for v, n in ((one, 2), (other, 3)):
        numbers(spark, n).write.parquet(version_path(path, v))
    commit(spark, path, one)
    with pytest.raises(CommitConflict):
        commit(spark, path, other)
    assert rows(read(spark, path)) == [(2,)]


def test_dimension_job_that_fails_midway(spark, tmp_path, monkeypatch):
    """The write of the second run fails; the history of the first is still there."""
    path = {n: str(tmp_path / n) for n in ("history", "seed", "snap", "leavers", "tabs", "out")}
    write(staff(spark, {"person_name": "Ann"}, {"person_name": "Bob"}), path["seed"])
    write(spark.createDataFrame([], LEAVERS), path["leavers"])
    write(snapshot(spark, {"person_name": "Ann", "job_title": "VP Sales"}), path["snap"])
    names = [path[n] for n in ("history", "seed", "snap", "leavers")]
    dimension_job(spark, *names, RunOptions(day("2021-01-01")))
    first = bag(read(spark, path["history"]))
    broken = snapshot(spark, {"person_name": "Cid"}).withColumn("gender", F.when(
        F.col("person_no") > 0, F.raise_error(F.lit("lost")).cast("string")))
    monkeypatch.setattr(jobs, "read", lambda session, where: broken if where == path["snap"]
                        else read(session, where))
    with pytest.raises(PySparkException):
        dimension_job(spark, *names, RunOptions(day("2021-01-02")))
    monkeypatch.undo()
    assert bag(read(spark, path["history"])) == first
    # the seed is not taken again, though the last write did not end
    land = spark.createDataFrame([("x",)], "a string")
    for tab in ("seed", "notes"):
        land.write.option("header", True).csv(f"{path['tabs']}/{tab}")
    assert land_tables(spark, path["tabs"], path["out"], seed="seed",
                       history=path["history"]) == ["notes"]
    dimension_job(spark, *names, RunOptions(day("2021-01-01")))
    assert bag(read(spark, path["history"])) == first  # a repeat changes nothing
