"""Landing of exported spreadsheet tabs as Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import read_records
from .tables import exists, write


def clean_table(df: DataFrame, int_columns: Sequence[str] = ()) -> DataFrame:
    """Lower-case text with nulls made ''; named columns become whole numbers.

    In ``int_columns`` text that is not all digits, or does not fit, becomes null.
    """
    cleaned = {}
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.name in int_columns:
            cleaned[field.name] = F.when(
                col.cast("string").rlike("^[0-9]+$"), col.try_cast("int"))
        elif isinstance(field.dataType, T.StringType):
            cleaned[field.name] = F.coalesce(F.lower(col), F.lit(""))
    return df.withColumns(cleaned)


def as_type(raw: DataFrame, source: str | None, field: T.StructField,
            missing: str = "NULL") -> tuple[Column, Column]:
    """A column's value, null where it is empty or the word ``missing``, and the value in the
    field's type, null where it cannot be read."""
    if source is None:
        none = F.lit(None)
        return none.cast("string"), none.cast(field.dataType)
    value, kind = F.col(f"`{source}`"), dict(raw.dtypes)[source]
    if kind == field.dataType.simpleString():
        return value, value
    if kind == "string":
        text = F.trim(value)
        value = F.when((text != "") & (F.upper(text) != missing.upper()), text)
    return value, value.try_cast(field.dataType)


def typed(raw: DataFrame, schema: T.StructType, missing: str = "NULL") -> DataFrame:
    """Bring a table to a schema; columns beyond it stay, after those of the schema.

    Numbers, dates and times may come as text: an empty cell and the word ``missing`` are null,
    anything else that cannot be read raises an error. Columns the table lacks are null.
    """
    found = {c.lower(): c for c in raw.columns}
    kinds = dict(raw.dtypes)

    def column(field: T.StructField) -> Column:
        source = found.get(field.name)
        value, cast = as_type(raw, source, field, missing)
        kind = field.dataType.simpleString()
        if source is None or kinds[source] == kind:
            return cast.alias(field.name)
        wrong = F.concat(F.lit(f"{source} has a value that is no {kind}: "), value.cast("string"))
        return F.when(value.isNotNull() & cast.isNull(), F.raise_error(wrong).cast(
            field.dataType)).otherwise(cast).alias(field.name)

    rest = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in schema.names]
    return raw.select(*[column(f) for f in schema.fields], *rest)


def tab_names(spark: SparkSession, src: str) -> list[str]:
    """Tabs below ``src``, one folder of CSV files each (``src/<tab>/*.csv``).

    Only file names are read. The list is as long as the spreadsheet has tabs.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(src))
    tab = F.element_at(F.split("path", "/"), -2)
    return sorted(r.tab for r in files.select(tab.alias("tab")).distinct().collect())


def read_tab(spark: SparkSession, src: str, tab: str,
             schema: T.StructType | None = None) -> DataFrame:
    """One tab; all columns are text unless a schema is given.

    Cells may be quoted, with doubled quotes, commas and line breaks inside; a large file is read
    by several tasks all the same. With a schema columns are found by name, those it does not
    have stay as text, and a cell that does not fit it is an error.
    """
    raw = read_records(spark, f"{src.rstrip('/')}/{tab}")
    return raw if schema is None else typed(raw, schema)


def land_tables(spark: SparkSession, src: str, dst: str, exclude: Sequence[str] = (),
                seed: str | None = None, history: str | None = None,
                schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """Store every tab as ``dst/<tab>.parquet``; returns the landed names.

    The ``seed`` tab is left out once the ``history`` table is there, since later runs go on
    from that table.
    """
    skipped = set(exclude)
    if seed and history and exists(spark, history):
        skipped.add(seed)
    landed = [tab for tab in tab_names(spark, src) if tab not in skipped]
    for tab in landed:
        write(read_tab(spark, src, tab, (schemas or {}).get(tab)),
              f"{dst.rstrip('/')}/{tab}.parquet")
    return landed
