"""Group values, ranks, latest rows and duplicate keys.

Values of groups of ordinary size come from windows, several of which share one shuffle. If hot
groups are asked for and there are some, values come from an aggregate, which Spark combines before
the shuffle, and a join that splits hot keys; ranks come from a sort by range. So no task gets a
whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle
from .ids import PLACE_BITS
from .spread import HotKeys, hot_keys, join_spread, renamed, same_keys


def with_group_values(df: DataFrame, keys: Sequence[str], values: dict[str, Column],
                      where: Column | None = None, hot: HotKeys | None = None,
                      hot_rows: int | None = None) -> DataFrame:
    """Add aggregates over each group, or over its rows that pass ``where``, to all its rows.

    Null keys form a group. ``values`` are plain aggregate expressions. ``hot`` may be on some of
    the keys.
    """
    hot = hot_keys(df, keys, hot_rows) if hot is None else hot
    if not hot and where is None:
        group = Window.partitionBy(*keys)
        return df.withColumns({name: value.over(group) for name, value in values.items()})
    if hot:
        df = settle(df)
    source = df if where is None else df.filter(where)
    groups = source.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    return join_spread(df, groups, keys, "left", hot=hot, null_safe=True)


def rank_in_group(df: DataFrame, keys: Sequence[str], order: str, tie: str,
                  rank: str = "rank_id", size: str | None = None,
                  hot: HotKeys | None = None) -> DataFrame:
    """Number a group's rows by (order, tie), and with ``size`` add the group's row count.

    Null keys form a group. If ``hot`` says that no group is hot, windows by the key do it, which
    need no more than the one shuffle that other windows by that key use. Else rows are sorted by
    range over many partitions, so that a group of any size is spread over several, and stored:
    places and counts must come from the same cut. Rows are then numbered within their partition
    only. A group that spans partitions is at an edge of each, so the table of what comes before
    has two rows per partition at most and is broadcast.
    """
    if hot is not None and not hot:
        group = Window.partitionBy(*keys)
        ranked = df.withColumn(rank, F.row_number().over(group.orderBy(order, tie)))
        count = F.count(F.lit(1)).over(group).cast("int")
        return ranked.withColumn(size, count) if size else ranked
    by = [*keys, order, tie]
    placed = settle(
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    pieces = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spanning = (
        pieces.withColumns({
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "_all": F.sum("_n").over(group), "_pieces": F.count(F.lit(1)).over(group)})
        .filter("_pieces > 1").select("_part", *keys, "_before", "_all"))
    here = ["_part", *keys]
    piece = Window.partitionBy(*here)
    ranked = (
        placed.withColumns({
            rank: F.row_number().over(piece.orderBy("_place")),
            "_size": F.count(F.lit(1)).over(piece)})
        .join(F.broadcast(renamed(spanning, here, "_s_")), same_keys(here, "_s_", True), "left"))
    ranked = ranked.withColumn(
        rank, (F.col(rank) + F.coalesce("_before", F.lit(0))).cast("int"))
    if size:
        ranked = ranked.withColumn(size, F.coalesce("_all", "_size").cast("int"))
    return ranked.drop("_place", "_part", "_size", "_before", "_all", *[f"_s_{c}" for c in here])


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, tie: str | None = None,
                keep_ties: bool = False) -> DataFrame:
    """The row with the greatest ``order`` per group.

    By default one row per group: nulls lose, ``tie`` (greater wins) decides between equals. With
    ``keep_ties`` all rows at the maximum stay and groups without any value drop out.
    """
    if keep_ties:
        tops = df.groupBy(*keys).agg(F.max(order).alias(order))
        return join_spread(df, tops, [*keys, order], "left_semi")
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(order, tie) if tie else F.struct(order)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def conflicting_owners(staff: DataFrame, owner: str = "owner_id",
                       person: str = "person_name") -> DataFrame:
    """Owners that more than one person has, with how many; lookups by owner would mix them."""
    pairs = staff.filter(F.col(owner).isNotNull()).select(owner, person).distinct()
    return duplicate_keys(pairs, [owner])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))
