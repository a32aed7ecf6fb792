"""CSV files cut into blocks anywhere, also within quotes."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from rosterline.sources import land_tables, read, read_records
from rosterline.sources.records import records
from tests.helpers import rows

CELLS = ["plain", "", "a,b", 'say "so"', "two\nlines", "three\n\n\nlines", 'end"\n"start', "é日",
         " padded ", "\r\nwindows\r\n", '"', '""', ",", "x" * 300, "\n"]


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 200 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                             "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, data, header=("id", "cell", "Last"), end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(data)


def table(seed, n=120):
    rng = random.Random(seed)
    return [(str(i), rng.choice(CELLS), rng.choice(["z", "", "l\nm"])) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_cut_files(spark, tmp_path, small_blocks, end):
    data = {f"f{i}": table(i) for i in range(2)}
    for name, own in data.items():
        written(tmp_path / f"{name}.csv", own, end=end)
    found = read_records(spark, str(tmp_path))
    assert found.columns == ["id", "cell", "Last"]
    expected = [tuple(c or None for c in r) for own in data.values() for r in own]
    assert rows(found) == sorted(expected, key=repr)
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20  # read by many tasks
    numbers = records(spark, str(tmp_path)).groupBy("file").agg(
        F.min("number").alias("a"), F.max("number").alias("b"), F.count("*").alias("n"))
    assert rows(numbers, "a", "b", "n") == [(0, 120, 121)] * 2


def test_one_block_gives_the_same(spark, tmp_path):
    written(tmp_path / "f.csv", table(5))
    assert rows(read_records(spark, str(tmp_path))) == sorted(
        [tuple(c or None for c in r) for r in table(5)], key=repr)


def test_odd_files(spark, tmp_path, small_blocks):
    path = tmp_path / "odd"
    path.mkdir()
    (path / "a.csv").write_text('x,,X,"n, m"\n\n1,2,3,4\n  \n5\n6,7,8,9,10\n11,,"",12')
    found = read_records(spark, str(path))
    assert found.columns == ["x0", "_c1", "X2", "n, m"]
    assert rows(found) == sorted([("1", "2", "3", "4"), ("5", None, None, None),
                                  ("6", "7", "8", "9"), ("11", None, None, "12")], key=repr)
    (path / "a.csv").write_text("")
    assert read_records(spark, str(path)).columns == []
    (path / "a.csv").write_text("a,b\n")
    assert rows(read_records(spark, str(path))) == []
    (path / "a.csv").write_text('a,b\n1,"never closed\n2,3\n')
    assert read_records(spark, str(path)).count() == 1


def test_landing_reads_cut_files(spark, tmp_path, small_blocks):
    tab = tmp_path / "tabs" / "people"
    tab.mkdir(parents=True)
    written(tab / "part.csv", table(3))
    assert land_tables(spark, str(tmp_path / "tabs"), str(tmp_path / "out")) == ["people"]
    landed = read(spark, str(tmp_path / "out" / "people.parquet"))
    assert rows(landed) == sorted([tuple(c or None for c in r) for r in table(3)], key=repr)
