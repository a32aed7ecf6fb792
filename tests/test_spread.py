from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rosterline.operators import (dense_ids, duplicate_keys, hot_keys, join_spread, latest_rows,
                                  max_value, rank_in_group, with_group_values)
from rosterline.operators.spread import hot_keys_each, split_left
from tests.helpers import bag, day, rows


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a third on none, copies among them."""
    rng = random.Random(5)
    data = [(i // 2, 7 if i % 3 == 0 else None if i % 3 == 1 else rng.randrange(40), i % 11)
            for i in range(900)]
    return spark.createDataFrame(data, "fact int, k int, at int")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [(k, f"v{k}-{i}", i * 4, i * 4 + 5) for k in [7, 7, *range(0, 60, 3), None]
         for i in range(2)], "k int, v string, lo int, hi int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("ranged", [False, True])
def test_split_join_equals_plain_join(facts, dim, how, ranged):
    where = F.col("at").between(F.col("lo"), F.col("hi")) if ranged else None
    split = join_spread(facts, dim, ["k"], how, where, hot_rows=20)
    renamed = dim.withColumnRenamed("k", "k2")
    condition = F.col("k") == F.col("k2")
    if ranged:
        condition &= where
    plain = facts.join(renamed, condition, how).drop("k2")
    assert bag(split) == bag(plain)
    assert bag(join_spread(facts, dim, ["k"], how, where)) == bag(plain)


def test_null_safe_split_join(facts, dim):
    split = join_spread(facts, dim, ["k"], "inner", hot_rows=20, null_safe=True)
    plain = facts.join(dim.withColumnRenamed("k", "k2"),
                       F.col("k").eqNullSafe(F.col("k2"))).drop("k2")
    assert bag(split) == bag(plain)


def test_hot_rows_are_split_evenly(facts):
    hot = hot_keys(facts, ["k"], 50)
    assert rows(hot.table.filter("k is not null")) == [(7, 7)]
    parts = split_left(facts.withColumn("n", F.monotonically_increasing_id()), hot, ["n"])
    sizes = [r[0] for r in parts.filter("k = 7").groupBy("_part").count().select("count").collect()]
    assert len(sizes) == 7 and max(sizes) < 90
    nulls = parts.filter("k is null").select("_part").distinct().count()
    assert nulls > 100


def test_no_hot_key_leaves_the_join_plain(facts, dim):
    assert not hot_keys(facts, ["k"])
    assert "_part" not in split_left(facts, hot_keys(facts, ["k"])).columns


def test_other_joins_are_refused(facts, dim):
    with pytest.raises(ValueError):
        join_spread(facts, dim, ["k"], "full")


def test_several_counts_in_one_pass(facts):
    by_k, by_at, by_both = hot_keys_each(facts, [["k"], ["at"], ["at", "k"]], 100)
    assert rows(by_k.table.filter("k is not null"), "k") == [(7,)]
    assert not by_at and not by_both
    low = hot_keys_each(facts, [["k"], ["at"]], 50)[1]
    assert rows(low.table, "at") == sorted([(i,) for i in range(11)], key=repr)


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_group_values(spark, facts, hot_rows):
    found = with_group_values(facts, ["k"], {"low": F.min("fact"), "n": F.count(F.lit(1))},
                              hot_rows=hot_rows)
    groups = {}
    for r in facts.collect():
        groups.setdefault(r["k"], []).append(r["fact"])
    got = found.collect()
    assert len(got) == 900
    assert all((r["low"], r["n"]) == (min(groups[r["k"]]), len(groups[r["k"]])) for r in got)


@pytest.mark.parametrize("parts", ["1", "4", "23"])
def test_rank_in_group(spark, parts):
    """Ranks do not depend on how many partitions a group spans."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_ranks(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_window_over_rows_is_by_the_key_alone(spark):
    df = spark.createDataFrame([(1, "a", 1)], "id long, k string, d int")
    plan = rank_in_group(df, ["k"], "d", "id", "rank", "size")._jdf.queryExecution() \
        .analyzed().toString()
    windows = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window")]
    # Those by the key alone run over pieces: one row per key and partition.
    assert windows and all("_part" in w or "_n#" in w or "count(1)" in w for w in windows)
    over_rows = [w for w in windows if "row_number" in w]
    assert over_rows and all("[_part#" in w for w in over_rows)


def _check_ranks(spark):
    rng = random.Random(2)
    data = [(i, None if i % 5 == 0 else "a" if i % 2 else "b",
             None if i % 31 == 0 else rng.randrange(6)) for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string, d int")
    got = {r["id"]: (r["rank"], r["size"]) for r in
           rank_in_group(df, ["k"], "d", "id", "rank", "size").collect()}
    expected = {}
    for key in ("a", "b", None):
        group = sorted((r for r in data if r[1] == key),
                       key=lambda r: (-1 if r[2] is None else r[2], r[0]))
        expected |= {r[0]: (n, len(group)) for n, r in enumerate(group, start=1)}
    assert got == expected


def test_latest_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, "a", 5), (3, "a", None), (4, "b", None), (5, "b", None), (6, "c", 1)],
        "id int, k string, at int")
    assert rows(latest_rows(df, ["k"], "at", "id")) == [(2, "a", 5), (5, "b", None), (6, "c", 1)]
    assert rows(latest_rows(df, ["k"], "at", keep_ties=True)) == [
        (1, "a", 5), (2, "a", 5), (6, "c", 1)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", day("2020-01-01"))] * 3 + [("b", day("2020-01-01"))],
                               "name string, dte date")
    assert rows(duplicate_keys(df, ["name", "dte"])) == [("a", day("2020-01-01"), 3)]


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 9).select((F.col("id") * 37 % 5000).alias("n")).repartition(7)
    known = spark.createDataFrame([(12,), (40,)], "id long")
    got = dense_ids(df, ["n"], max_value(known)).collect()
    assert sorted((r["n"], r["id"]) for r in got) == [(n, n + 41) for n in range(5000)]


def test_dense_ids_of_nothing(spark):
    none = spark.createDataFrame([], "n int")
    assert dense_ids(none, ["n"], max_value(spark.createDataFrame([], "id long"))).count() == 0
