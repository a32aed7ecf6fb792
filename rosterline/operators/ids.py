"""Dense surrogate ids without moving all rows to one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle

# monotonically_increasing_id() holds the partition above bit 33 and the row's place below.
PLACE_BITS = 33


def max_value(df: DataFrame, col: str = "id") -> Column:
    """The greatest value as a scalar subquery; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(col), F.lit(0))).scalar()


def dense_ids(df: DataFrame, order: Sequence[str], start: Column, id_col: str = "id") -> DataFrame:
    """Add ids start+1, start+2, ... in the given order, which must be a total one.

    Rows are sorted over many partitions by range, then written out once: both the partition
    sizes and the rows must come from the same cut, also when a task is run again.
    """
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    # One row per partition, so one task is enough for the running total.
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_place", PLACE_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_col, (start + F.col("_before") + place + 1).cast("long"))
        .drop("_part", "_place", "_before")
    )
