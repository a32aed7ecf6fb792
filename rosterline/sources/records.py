"""CSV files with quoted line breaks, read by several tasks per file.

Spark's own reader takes a whole file in one task as soon as cells may hold line breaks. Here files
are read as plain lines, in blocks like any text. Whether a line break lies in quotes depends on
the number of quotes before it, so these are summed per block, and blocks add up what comes before
them: one row per block. Lines are then put together to records, and records are parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
BLOCK = ["_file", "_block"]


def _before(df: DataFrame, value: str, into: str) -> DataFrame:
    """Add what the earlier blocks of a file sum up to; one row per block."""
    earlier = (Window.partitionBy("_file").orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(into, F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files: file, number in the file from 0, and the text without its end.

    Line breaks may be LF or CR LF; those in quotes stay as they are. Blank lines outside quotes
    are no records. The rest of a file after a quote that is never closed is one record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"), "value",
        F.regexp_count("value", F.lit(QUOTE)).cast("long").alias("_quotes"))
    in_block = Window.partitionBy(*BLOCK).orderBy("_place")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    quotes = _before(lines.groupBy(*BLOCK).agg(F.sum("_quotes").alias("_all")), "_all", "_open")
    # A line after an even number of quotes starts a record.
    opened = F.col("_open") + F.coalesce(F.sum("_quotes").over(earlier), F.lit(0))
    told = (lines.join(quotes.drop("_all"), BLOCK)
            .withColumn("_starts", (opened % 2 == 0).cast("long")))
    starts = _before(told.groupBy(*BLOCK).agg(F.sum("_starts").alias("_n")), "_n", "_first")
    numbered = told.join(starts.drop("_n"), BLOCK).withColumn(
        "_record", F.col("_first") + F.sum("_starts").over(so_far) - 1)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("_block", "_place", "value"))), lambda x: x.value), "\n")
    whole = numbered.groupBy("_file", "_record").agg(text.alias("record"))
    return whole.select(
        F.col("_file").alias("file"), F.col("_record").alias("number"),
        F.regexp_replace("record", "\r$", "").alias("record")).filter(
        F.length(F.trim("record")) > 0)


def _cells(record: Column, names: list[str]) -> Column:
    """A record's cells as text; missing ones are null."""
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return F.from_csv(record, fields, {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE"})


def _names(spark: SparkSession, head: str) -> list[str]:
    """The names in a header; a nameless or repeated column is told by its place."""
    most = head.count(",") + 1
    row = spark.range(1).select(
        _cells(F.lit(head), [f"c{i}" for i in range(most)]).alias("c")).select("c.*").first()
    cells = list(row)
    while cells and cells[-1] is None:
        cells.pop()
    lower = [(c or "").lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c
            for i, c in enumerate(cells)]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header each, all the same, as a table of text.

    An empty cell is null, as is one that a short record lacks; cells beyond the header are left
    out. Without a record the table has no column.
    """
    found = records(spark, path)
    first = found.groupBy("file").agg(F.min_by("record", "number").alias("head"),
                                      F.min("number").alias("least"))
    head = first.agg(F.min_by("head", "file")).first()[0]
    if head is None:
        return spark.createDataFrame([], T.StructType())
    heads = first.select(F.col("file").alias("_file"), "least")
    body = found.join(heads, (F.col("file") == F.col("_file")) & (F.col("number") > F.col("least")))
    return body.select(_cells(F.col("record"), _names(spark, head)).alias("c")).select("c.*")
