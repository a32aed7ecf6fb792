"""Landing of text as typed tables, with what cannot be read set aside.

One pass types the rows, counts bad values per column and writes both kinds of rows: a version of
the table has a partition of accepted rows and one of rejects. It is committed only if few enough
rows were rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import as_type
from .versions import commit, latest, new_version, open_version, version_path

REJECTED, REASONS = "_rejected", "_bad"


@dataclass(frozen=True)
class Landed:
    """What a landing found; ``by_column`` counts values that could not be read."""

    rows: int
    rejected: int
    by_column: dict[str, int]


class TooManyRejects(ValueError):
    """More rows were rejected than allowed; nothing was committed."""

    def __init__(self, found: Landed, path: str):
        super().__init__(f"{found.rejected} of {found.rows} rows for {path} cannot be read: "
                         f"{ {c: n for c, n in found.by_column.items() if n} }")
        self.found = found


def judged(raw: DataFrame, schema: T.StructType, missing: str = "NULL",
           required: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows with ``_bad``, the column and the text of each value that cannot be read.

    Such values are null. ``required`` columns must have a value, too. Columns beyond the schema
    stay, after those of it.
    """
    found = {c.lower(): c for c in raw.columns}
    columns: list[Column] = []
    reasons: list[Column] = []
    for field in schema.fields:
        value, cast = as_type(raw, found.get(field.name.lower()), field, missing)
        wrong = value.isNotNull() & cast.isNull()
        if field.name in required:
            wrong |= value.isNull()
        columns.append(cast.alias(field.name))
        reasons.append(F.when(wrong, F.struct(
            F.lit(field.name).alias("column"), value.cast("string").alias("value"))))
    rest = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in schema.names]
    bad = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return raw.select(*columns, *rest, bad.alias(REASONS))


def land_typed(raw: DataFrame, schema: T.StructType, path: str, most: float = 0.01,
               missing: str = "NULL", required: tuple[str, ...] = ()) -> Landed:
    """Write a table of text as the next version of a typed one, bad rows apart.

    Raises :class:`TooManyRejects`, and commits nothing, if the share of rejected rows is above
    ``most``.
    """
    spark = raw.sparkSession
    rows = judged(raw, schema, missing, required).withColumn(REJECTED, F.size(REASONS) > 0)
    seen = Observation()
    named = F.transform(REASONS, lambda r: r["column"])
    counts = [F.count_if(F.array_contains(named, f.name)).alias(f"c{i}")
              for i, f in enumerate(schema.fields)]
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"),
                           F.count_if(REJECTED).alias("rejected"), *counts)
    version = new_version(spark, path, rows.schema)
    watched.write.partitionBy(REJECTED).parquet(version_path(path, version))
    found = Landed(seen.get["rows"], seen.get["rejected"],
                   {f.name: seen.get[f"c{i}"] for i, f in enumerate(schema.fields)})
    if found.rejected > most * found.rows:
        raise TooManyRejects(found, path)
    commit(spark, path, version)
    return found


def _part(spark: SparkSession, path: str, rejected: bool) -> DataFrame:
    version = latest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version at {path}")
    rows = open_version(spark, path, version)
    return rows.filter(F.col(REJECTED) == F.lit(rejected)).drop(REJECTED)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows of the last landing."""
    return _part(spark, path, False).drop(REASONS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows of the last landing, with ``_bad``: columns and texts that are wrong."""
    return _part(spark, path, True)
