"""A dimension in buckets: only those of which a snapshot says something new are written."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rosterline.operators import prepare_snapshot, scd2_close_changed, scd2_new_versions
from rosterline.plans import apply_snapshot, snapshot_digests, store_in_buckets
from rosterline.plans import buckets as module
from rosterline.sources import (TooManyRejects, latest, land_typed, read, read_landed,
                                read_rejects, stored_max, write)
from rosterline.schemas import COMPANY
from tests.helpers import bag, day, rows, snapshot, staff

RUN = day("2021-05-01")
NAMES = [f"P{i}" for i in range(40)]


def files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def people(spark, **changes):
    return prepare_snapshot(snapshot(spark, *[
        {"person_name": n, **changes.get(n, {})} for n in NAMES]))


@pytest.mark.parametrize("null_safe", [False, True])
def test_one_change_writes_one_bucket(spark, tmp_path, null_safe):
    path, digests = str(tmp_path / "dim"), str(tmp_path / "digests")
    dim = staff(spark, *[{"person_name": n} for n in NAMES])
    store_in_buckets(dim, path, 8)
    options = {"buckets": 8, "null_safe": null_safe}
    first = people(spark)
    assert apply_snapshot(spark, path, digests, first, RUN, **options) == list(range(8))
    assert bag(read(spark, path).drop("bucket")) == bag(dim)
    before = files(path)
    assert apply_snapshot(spark, path, digests, first, RUN, **options) == []
    assert files(path) == before
    for change, opens in (({"job_title": "VP Sales"}, True), ({"gender": None}, null_safe)):
        new = people(spark, P7=change)
        before, was = files(path), read(spark, path).drop("bucket").collect()
        dim = spark.createDataFrame(was, dim.schema)
        closed = scd2_close_changed(dim, new, RUN, null_safe=null_safe)
        expected = bag(scd2_new_versions(closed, new, RUN, null_safe=null_safe))
        changed = apply_snapshot(spark, path, digests, new, RUN, **options)
        assert len(changed) == 1
        assert {f.split("/")[0] for f in before - files(path)} == {f"bucket={changed[0]}"}
        assert bag(read(spark, path).drop("bucket")) == expected
        assert (len(was) < read(spark, path).count()) == opens
        apply_snapshot(spark, path, digests, people(spark), RUN, **options)


def test_a_run_that_stops_is_made_good(spark, tmp_path, monkeypatch):
    path, digests = str(tmp_path / "dim"), str(tmp_path / "digests")
    store_in_buckets(staff(spark, *[{"person_name": n} for n in NAMES]), path, 4)
    apply_snapshot(spark, path, digests, people(spark), RUN, 4)
    new = people(spark, P1={"area": "Care"}, P2={"area": "Care"})

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "commit", stop)
    with pytest.raises(RuntimeError):
        apply_snapshot(spark, path, digests, new, RUN, 4)
    monkeypatch.undo()
    assert latest(spark, digests).number == 1
    once = bag(read(spark, path))
    assert apply_snapshot(spark, path, digests, new, RUN, 4)
    assert bag(read(spark, path)) == once
    assert apply_snapshot(spark, path, digests, new, RUN, 4) == []


def test_digests_tell_repeated_rows(spark):
    one, other = people(spark), people(spark, P3={"country": "PE"})
    assert bag(snapshot_digests(one, 4)) == bag(snapshot_digests(one.orderBy(F.rand(1)), 4))
    assert bag(snapshot_digests(one, 4)) != bag(snapshot_digests(other, 4))
    assert bag(snapshot_digests(one.unionByName(one), 1)) != bag(
        snapshot_digests(other.unionByName(other), 1))


def test_greatest_value_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, i % 3, f"x{i}") for i in range(50)], "id long, p int, t string")
    write(df, path, ["p"])
    assert stored_max(spark, path, "id") == 49
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = own.read.parquet(path).agg(F.max("id"))._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(id)]" in plan  # footers only: no column of a row is read
    write(df.limit(0), path)
    assert stored_max(spark, path, "id") is None
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_rejects_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "t")
    raw = spark.createDataFrame([("1", " 5 ", "a"), ("x", "NULL", "b"), ("3", "y", "c"),
                                 ("z", "w", "d"), (None, "7", "e"), ("6", "", "f")],
                                "company_id string, Row_Tag string, note string")
    found = land_typed(raw, COMPANY, path, most=0.9, required=("company_id",))
    assert (found.rows, found.rejected) == (6, 4)
    assert found.by_column == {"company_id": 3, "row_tag": 2}
    assert rows(read_landed(spark, path), "company_id", "row_tag", "note") == sorted([
        (1, 5, "a"), (6, None, "f")], key=repr)
    assert rows(read_rejects(spark, path).select(
        "note", F.to_json("_bad").alias("bad"))) == [
        ("b", '[{"column":"company_id","value":"x"}]'),
        ("c", '[{"column":"row_tag","value":"y"}]'),
        ("d", '[{"column":"company_id","value":"z"},{"column":"row_tag","value":"w"}]'),
        ("e", '[{"column":"company_id"}]')]


def test_too_many_rejects_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([("1", "2")], "company_id string, row_tag string")
    land_typed(good, COMPANY, path)
    bad = spark.createDataFrame([("1", "2"), ("x", "2")], "company_id string, row_tag string")
    with pytest.raises(TooManyRejects) as error:
        land_typed(bad, COMPANY, path)
    assert error.value.found.by_column == {"company_id": 1, "row_tag": 0}
    assert rows(read_landed(spark, path)) == [(1, 2)]
    assert read_rejects(spark, path).isEmpty()
    land_typed(good.limit(0), COMPANY, path)
    assert read_landed(spark, path).isEmpty() and read_rejects(spark, path).isEmpty()
    with pytest.raises((FileNotFoundError, PySparkException)):
        read_landed(spark, str(tmp_path / "none"))
