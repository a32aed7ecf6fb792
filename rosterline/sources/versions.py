"""Tables that keep their versions, so that a failed write leaves the last one in place.

A version is a folder of Parquet files of its own. It counts only from the moment its marker is
there: the marker is written last and looked for first, and it names the folder. A run that stops
before has changed nothing that a reader sees; what it left is removed by a later write.

    table/_versions/0000000007-<random>/   files
    table/_commits/0000000007              the marker

Names begin with an underscore, so plain files that were in the folder before the first version
can still be read, and are, until there is a marker.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS, COMMITS = "_versions", "_commits"
DIGITS = 10
KEEP = 2


class CommitConflict(RuntimeError):
    """Another run has committed a version meanwhile."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str                # the name below _versions
    schema: str | None = None  # as JSON, so that a version without a row can be read


class Files:
    """The file system of a path, through Hadoop, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.place(path).getFileSystem(conf)

    def place(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        """What is in a folder; nothing if there is no such folder."""
        place = self.place(path)
        if not self.system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(place))

    def text(self, path: str) -> str:
        stream = self.system.open(self.place(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8", "replace")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one."""
        try:
            stream = self.system.create(self.place(path), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, path: str) -> None:
        self.system.delete(self.place(path), True)


def _number(name: str) -> int | None:
    digits = name[:DIGITS]
    return int(digits) if len(digits) == DIGITS and digits.isdigit() else None


def _marker(files: Files, path: str, number: int) -> Version | None:
    """What a marker says; None if it was cut short."""
    try:
        said = json.loads(files.text(f"{path}/{COMMITS}/{number:0{DIGITS}}"))
        return Version(number, said["folder"], said.get("schema"))
    except (ValueError, KeyError, TypeError):
        return None


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The committed versions of a table, oldest first."""
    path = path.rstrip("/")
    files = Files(spark, path)
    numbers = [_number(n) for n in files.names(f"{path}/{COMMITS}")]
    found = [_marker(files, path, n) for n in numbers if n is not None]
    return [v for v in found if v is not None]


def latest(spark: SparkSession, path: str) -> Version | None:
    """The last committed version of a table; None if it has none."""
    path = path.rstrip("/")
    files = Files(spark, path)
    for name in reversed(files.names(f"{path}/{COMMITS}")):
        number = _number(name)
        version = None if number is None else _marker(files, path, number)
        if version is not None:
            return version
    return None


def version_path(path: str, version: Version) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{version.folder}"


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A committed version, by default the last."""
    found = latest(spark, path) if number is None else next(
        (v for v in versions(spark, path) if v.number == number), None)
    if found is None:
        raise FileNotFoundError(f"no version {'' if number is None else number} at {path}")
    return open_version(spark, path, found)


def open_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The rows of a version, committed or just written."""
    reader = spark.read
    if version.schema is not None:
        reader = reader.schema(StructType.fromJson(json.loads(version.schema)))
    return reader.parquet(version_path(path, version))


def new_version(spark: SparkSession, path: str, schema: StructType | None = None) -> Version:
    """A folder for the next version; it is not one before :func:`commit`."""
    files = Files(spark, path)
    taken = [n for name in files.names(f"{path.rstrip('/')}/{COMMITS}")
             if (n := _number(name)) is not None]
    number = max(taken, default=0) + 1  # after markers cut short, too
    return Version(number, f"{number:0{DIGITS}}-{uuid.uuid4().hex}",
                   None if schema is None else schema.json())


def commit(spark: SparkSession, path: str, version: Version, keep: int = KEEP) -> None:
    """Make a written folder the table's last version, and remove what is no longer needed.

    Raises :class:`CommitConflict` if another run has taken the number; its version stays. That
    needs a file system that creates a file once only (HDFS, local disks); on a store that does
    not, the later of two markers counts. The ``keep`` last versions stay, so that readers of the
    one before can finish.
    """
    path = path.rstrip("/")
    files = Files(spark, path)
    marker = f"{path}/{COMMITS}/{version.number:0{DIGITS}}"
    said = {"folder": version.folder, "schema": version.schema}
    if not files.create(marker, json.dumps(said)):
        files.delete(version_path(path, version))
        raise CommitConflict(f"version {version.number} of {path} was written meanwhile")
    kept = versions(spark, path)[-keep:]
    folders = {v.folder for v in kept}
    for name in files.names(f"{path}/{VERSIONS}"):
        number = _number(name)  # later ones may be a running write
        if number is not None and number <= version.number and name not in folders:
            files.delete(f"{path}/{VERSIONS}/{name}")
    for name in files.names(f"{path}/{COMMITS}"):
        number = _number(name)
        if number is not None and number < kept[0].number:
            files.delete(f"{path}/{COMMITS}/{name}")


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  sort_by: Sequence[str] = (), keep: int = KEEP) -> Version:
    """Write a DataFrame as the next version of a table; it may read the table itself."""
    version = stage_version(df, path, partition_by, sort_by)
    commit(df.sparkSession, path, version, keep)
    return version


def stage_version(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  sort_by: Sequence[str] = ()) -> Version:
    """Write a DataFrame as what :func:`commit` can make the next version of a table."""
    version = new_version(df.sparkSession, path, df.schema)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.partitionBy(*partition_by).parquet(version_path(path, version))
    return version
