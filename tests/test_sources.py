from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.sources import (clean_table, exists, land_tables, read, read_first, register,
                                save_table, scratch, settle, staged_overwrite, tab_names, typed,
                                write)
from rosterline.sources.tables import default_shared_dir, shared_dir
from tests.helpers import bag, day, rows


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 2020), (2, "b", 2020), (3, "c", 2021)],
                                 "id int, name string, yyyy int")


def test_write_replaces(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write(table, path)
    write(table.filter("id = 1"), path)
    assert read(spark, path).count() == 1


def test_partitioned_write_prunes(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write(table, path, ["yyyy"])
    assert (tmp_path / "t" / "yyyy=2021").is_dir()
    found = read(spark, path)
    assert bag(found) == bag(table)
    plan = found.filter("yyyy = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan


def test_table_that_is_its_own_input(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write(table, path)
    grown = read(spark, path).withColumn("id", F.col("id") + 10)
    staged_overwrite(grown, path, str(tmp_path / "staging"))
    assert rows(read(spark, path), "id") == [(11,), (12,), (13,)]


def test_first_table_that_exists(spark, table, tmp_path):
    seed, history = str(tmp_path / "seed"), str(tmp_path / "history")
    write(table, seed)
    assert not exists(spark, history) and exists(spark, seed)
    assert read_first(spark, [history, seed]).count() == 3
    write(table.filter("id = 2"), history)
    assert read_first(spark, [history, seed]).count() == 1
    with pytest.raises(FileNotFoundError):
        read_first(spark, [str(tmp_path / "x")])


def test_broken_table_is_not_taken_for_a_missing_one(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        exists(spark, str(tmp_path / "bad"))


def test_names_for_sql_and_catalog(spark, table):
    for _ in range(2):
        register(table, "people_view")
        save_table(table, "people_table")
    assert spark.sql("select count(*) from people_view").first()[0] == 3
    assert bag(spark.table("people_table")) == bag(table)
    spark.sql("drop table people_table")


def test_settle(spark, table):
    stored = settle(table.withColumn("s", F.struct("id", F.array("name"))))
    assert stored.count() == 3
    plan = stored.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<id:int>" in plan


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_shared_folder():
    assert shared_dir(_Session(spark_checkpoint_dir="/shared/x")) == "/shared/x"
    for master in ("local[2]", "yarn"):
        with pytest.raises(RuntimeError):
            shared_dir(_Session(spark_master=master))


def test_default_shared_folder():
    session = _Session(spark_master="local[2]", spark_sql_warehouse_dir="/house/")
    session.conf.set = session.conf.__setitem__
    default_shared_dir(session)
    assert shared_dir(session) == "/house/_shared"
    cluster = _Session(spark_master="yarn", spark_sql_warehouse_dir="/house/")
    default_shared_dir(cluster)
    with pytest.raises(RuntimeError):
        shared_dir(cluster)


def test_scratch_goes_at_the_end(spark, table):
    kept = settle(table)
    with scratch(spark):
        gone = settle(table)
        assert gone.count() == 3
    assert kept.count() == 3
    assert not any(exists(spark, p) for p in gone.inputFiles())


def test_typed(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType()),
                           T.StructField("s", T.StringType()), T.StructField("x", T.LongType())])
    raw = spark.createDataFrame([(" 5 ", "2020-01-02", " NULL", "own"), ("NULL", "", None, None),
                                 ("null", None, "t", "")],
                                "N string, d string, s string, extra string")
    got = typed(raw, schema)
    assert got.columns == ["n", "d", "s", "x", "extra"]
    assert rows(got) == sorted([(5, day("2020-01-02"), " NULL", None, "own"),
                                (None, None, None, None, None), (None, None, "t", None, "")],
                               key=repr)
    for bad in ("15/03/2021", "x"):
        with pytest.raises(Exception, match="d has a value that is no date"):
            typed(spark.createDataFrame([(bad,)], "d string"), schema).collect()


def test_landing_of_quoted_cells(spark, tmp_path):
    folder = tmp_path / "tabs" / "notes"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('id,note\n1,"a, ""b"""\n2,"two\nlines"\n3,"1,5 ""x"" é"\n')
    (tmp_path / "tabs" / "bad").mkdir()
    (tmp_path / "tabs" / "bad" / "a.csv").write_text("id,note\nx,y\n")
    src, dst = str(tmp_path / "tabs"), str(tmp_path / "landed")
    schema = T.StructType([T.StructField("id", T.IntegerType()),
                           T.StructField("note", T.StringType())])
    land_tables(spark, src, dst, exclude=["bad"], schemas={"notes": schema})
    assert rows(read(spark, f"{dst}/notes.parquet")) == [
        (1, 'a, "b"'), (2, "two\nlines"), (3, '1,5 "x" é')]
    with pytest.raises(Exception):
        land_tables(spark, src, dst, exclude=["notes"], schemas={"bad": schema})


def test_clean_table(spark):
    df = spark.createDataFrame([("AbC", None, "12", 1), (None, 2, "x1", 2), ("É", 3, None, 3),
                                ("", 4, "99999999999", 4)],
                               "Name string, n int, digits string, id int")
    got = clean_table(df, ["digits"])
    assert rows(got) == sorted([("abc", None, 12, 1), ("", 2, None, 2), ("é", 3, None, 3),
                                ("", 4, None, 4)], key=repr)
    assert dict(clean_table(df).dtypes)["digits"] == "string"


def test_landing(spark, table, tmp_path):
    src, dst, history = (str(tmp_path / n) for n in ("tabs", "landed", "history"))
    for tab in ("people", "seed", "broken"):
        table.write.option("header", True).csv(f"{src}/{tab}")
    assert tab_names(spark, src) == ["broken", "people", "seed"]
    args = {"exclude": ["broken"], "seed": "seed", "history": history}
    assert land_tables(spark, src, dst, **args) == ["people", "seed"]
    write(table, history)
    assert land_tables(spark, src, dst, **args) == ["people"]
    landed = read(spark, f"{dst}/people.parquet")
    assert landed.dtypes == [("id", "string"), ("name", "string"), ("yyyy", "string")]
    typed = land_tables(spark, src, dst, **args, schemas={"people": table.schema})
    assert typed == ["people"] and bag(read(spark, f"{dst}/people.parquet")) == bag(table)
