"""Parquet tables: read, write, replace, and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .versions import COMMITS, VERSIONS, Files, latest, open_version


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for a null


def read(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table: its last committed version if it keeps versions, else its files."""
    version = latest(spark, path)
    return spark.read.parquet(path) if version is None else open_version(spark, path, version)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a Parquet table at the path; other errors are raised.

    A folder with no more than an uncommitted first version holds no table yet.
    """
    try:
        read(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        inside = Files(spark, path).names(path)
        if inside and set(inside) <= {VERSIONS, COMMITS}:
            return False
        raise
    return True


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first table that is there: a job's own output, else the seed."""
    for path in paths:
        if exists(spark, path):
            return read(spark, path)
    raise FileNotFoundError(f"no table at any of {list(paths)}")


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
FEW_VALUES = 16  # files of as many partition values may be open in a task that need not sort


@contextmanager
def _as_they_come(spark: SparkSession, placed: bool) -> Iterator[None]:
    """If rows are ``placed``, let a write by partition leave their order; else it sorts them."""
    before = spark.conf.get(OPEN_FILES)
    if placed:
        spark.conf.set(OPEN_FILES, FEW_VALUES)
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def write(df: DataFrame, path: str, partition_by: Sequence[str] = (),
          sort_by: Sequence[str] = (), placed: bool = False) -> None:
    """Replace the table at the path.

    With ``partition_by`` rows are first gathered by partition value; REBALANCE splits values
    with much data over several files and joins small ones. ``sort_by`` orders each file, not
    the whole table, so that readers can skip parts of it. Rows that are ``placed`` come gathered
    and in order, and are neither moved nor sorted again.
    """
    if partition_by and not placed:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by and not placed:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    with _as_they_come(df.sparkSession, placed):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_partitions(df: DataFrame, path: str, by: str, values: Sequence[int | None],
                     sort_by: Sequence[str] = (), placed: bool = False) -> None:
    """Replace those partitions of a table that ``values`` name; the others' files stay.

    ``df`` holds their rows and no others. A value without rows loses its partition. A run that
    stops midway has replaced some of them; to run again replaces all. ``placed`` as in
    :func:`write`.
    """
    spark = df.sparkSession
    values = list(dict.fromkeys(values))
    if not values:
        return
    seen = Observation()
    counted = [F.count_if(F.col(by).eqNullSafe(F.lit(v))).alias(f"v{i}")
               for i, v in enumerate(values)]
    gathered = df if placed else df.hint("rebalance", F.col(by))
    if sort_by and not placed:
        gathered = gathered.sortWithinPartitions(by, *sort_by)
    with _as_they_come(spark, placed):
        (gathered.observe(seen, *counted).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    files = Files(spark, path)
    for i, v in enumerate(values):
        if not seen.get[f"v{i}"]:
            files.delete(f"{path.rstrip('/')}/{by}={NO_VALUE if v is None else v}")


def staged_overwrite(df: DataFrame, path: str, staging: str,
                     partition_by: Sequence[str] = ()) -> None:
    """Replace a table that the DataFrame itself reads, by way of a staging table.

    A run that stops during the second write leaves the table broken: for tables that can be made
    again. What cannot, like a history, is written with ``write_version``.
    """
    write(df, staging)
    write(read(df.sparkSession, staging), path, partition_by)


def stored_max(spark: SparkSession, path: str, col: str) -> int | None:
    """The greatest value of a column of a stored table, from the files' footers alone.

    Only the other Parquet reader of Spark can answer an aggregate from footers, so this runs in
    a session of its own settings. Null for a table without a value.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return read(own, path).agg(F.max(col)).first()[0]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


def save_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table with the result of a query."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL; may be repeated in a session."""
    df.createOrReplaceTempView(name)
    return df


SHARED = "spark.checkpoint.dir"
LOCAL_SHARED = "rosterline.shared.dir"  # the first cannot be set in a running session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from spark.checkpoint.dir."""
    folder = spark.conf.get(SHARED, None) or spark.conf.get(LOCAL_SHARED, None)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def default_shared_dir(spark: SparkSession) -> None:
    """Give a local session that has no spark.checkpoint.dir a folder in its warehouse."""
    if (spark.conf.get(SHARED, None) is None
            and spark.conf.get("spark.master").startswith("local[")):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.conf.set(LOCAL_SHARED, f"{warehouse}/_shared")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch tables that were stored meanwhile."""
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = hadoop(path)
            place.getFileSystem(conf).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    paths = _made.get()
    if paths is not None:
        paths.append(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Store an intermediate result in the shared folder and go on from there.

    Used where a plan reads a result several times. The table survives the loss of executors;
    unlike a checkpoint it is columnar, so that later steps read the columns they need, and
    tells its size.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, *keys: str) -> DataFrame:
    """Store an intermediate result in buckets of its keys and go on from there.

    Joins and groups by the keys then read it without a shuffle of its rows. Buckets need a table
    of the catalog; its entry is dropped at once, as what was looked up with it stays known.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"settled_{uuid.uuid4().hex}", scratch_path(spark, "buckets")
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    stored = spark.table(name).select(*df.columns)
    spark.sql(f"drop table {name}")
    return stored
