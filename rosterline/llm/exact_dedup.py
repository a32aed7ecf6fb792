"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of fixed size. All blocks are sorted, and equal blocks get
the same integer name. Then adjacent names of a document are paired, the pairs are sorted and
named in turn, and so on until one name is left: two texts of as many blocks have the same name
if and only if they are equal. No step relies on a hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold_case, settle

BLOCK_BYTES = 256


def name_by_sort(df: DataFrame, keys: Sequence[str], tie: str, name: str = "name") -> DataFrame:
    """Replace the key columns by one integer that is equal exactly where all keys are equal.

    Rows are sorted by range over many partitions; ``tie`` lets a very frequent key span several.
    Each partition numbers its own runs of equal keys; one row per partition tells how many there
    are and whether the first run continues the last one before. The result is stored.
    """
    rest = [c for c in df.columns if c not in keys]
    columns = [*rest, *keys]
    types = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, number, schema = None, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = schema or pa.schema([
                *[f.with_nullable(True) for f in batch.schema],
                pa.field("_part", pa.int32()), pa.field("_place", pa.int64()),
                pa.field("_edge", pa.int32())])
            own = [batch.column(columns.index(k)) for k in keys]
            starts = np.zeros(batch.num_rows, dtype=bool)
            for array in own:
                # Keys are never null.
                starts[1:] |= pc.not_equal(array[1:], array[:-1]).to_numpy(zero_copy_only=False)
            here = [array[0].as_py() for array in own]
            starts[0] = here != last
            places = number + np.cumsum(starts)
            if last is None:
                yield edge(schema, here, part, 0, 1)
            last, number = [array[-1].as_py() for array in own], int(places[-1])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(columns.index(c)) for c in rest],
                 *[pa.nulls(n, array.type) for array in own],
                 pa.array(np.full(n, part, dtype=np.int32)), pa.array(places),
                 pa.array(np.zeros(n, dtype=np.int32))], schema=schema)
        if last is not None:
            yield edge(schema, last, part, number, 2)

    def edge(schema, values, part, place, kind):
        found = dict(zip(keys, values)) | {"_part": part, "_place": place, "_edge": kind}
        return pa.RecordBatch.from_arrays(
            [pa.array([found.get(f.name)], f.type) for f in schema], schema=schema)

    schema = ", ".join([*[f"{c} {types[c]}" for c in columns], "_part int", "_place long",
                        "_edge int"])
    numbered = settle(
        df.select(*columns).repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
        .mapInArrow(run, schema))
    # One row per partition from here on, so that one task is enough and a broadcast is bounded.
    edges = numbered.filter("_edge > 0").groupBy("_part").agg(
        F.max("_place").alias("_last_place"),
        *[F.max(F.when(F.col("_edge") == e, F.col(k))).alias(f"_{k}_{e}")
          for k in keys for e in (1, 2)])
    order = Window.orderBy("_part")
    tied = F.lit(True)
    for k in keys:
        tied &= F.coalesce(F.col(f"_{k}_1") == F.lag(f"_{k}_2").over(order), F.lit(False))
    offsets = edges.select(
        "_part", (F.col("_last_place") + 1).alias("_n"), tied.cast("int").alias("_tied"),
    ).select("_part", (
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        - F.sum("_tied").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("_before"))
    return (numbered.filter("_edge = 0").join(F.broadcast(offsets), "_part")
            .select(*rest, (F.col("_before") + F.col("_place")).alias(name)))


def block_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, text_sha256, and the identity (level, name) of its normalised text.

    Rows have equal identities exactly if their texts are equal after lower-casing A-Z.
    """
    raw = F.encode(fold_case(F.col(text_col)), "UTF-8")
    # Stored, as the sort by range reads its input twice, once for the bounds of the ranges.
    cut = settle(docs.select(F.col(id_col).alias("doc_id"), raw.alias("raw")).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "raw",
        F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / block_bytes)).cast("int").alias("n"),
        F.sha2("raw", 256).alias("sha")))
    blocks = cut.select(
        "row_id", "doc_id", "n", "sha",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: F.substring(F.col("raw"), i * block_bytes + 1, F.lit(block_bytes))))
        .alias("pos", "block"),
    ).select("row_id", F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"), "n",
             F.when(F.col("pos") == 0, F.col("sha")).alias("sha"), "pos", "block")
    named = name_by_sort(blocks, ["block"], "row_id")
    heads = named.filter("pos = 0").select("row_id", "doc_id", "sha", "n", "name")
    levels = max((named.agg(F.max("n")).first()[0] or 1) - 1, 0).bit_length()
    done = heads.filter("n = 1").select("row_id", F.lit(0).alias("level"), "name")
    current = named.filter("n > 1").select("row_id", "pos", "n", "name")
    for level in range(1, levels + 1):
        pairs = current.groupBy("row_id", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.expr("(max(n) + 1) div 2").cast("int").alias("n"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        current = name_by_sort(pairs, ["a", "b"], "row_id")
        done = done.unionByName(
            current.filter("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        current = current.filter("n > 1")
    return heads.drop("name", "n").join(done, "row_id").select(
        "doc_id", F.col("sha").alias("text_sha256"), "level", "name")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, level, name.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty, so null and
    empty texts form one group. Of equal texts the row with the largest id stays; if that id is
    repeated, all rows that carry it stay. A null id never wins against another; a group of null
    ids only keeps all its rows. Other columns are not read. An empty table gives no rows.
    """
    rows = settle(block_names(docs, id_col, text_col, block_bytes))
    groups = rows.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Stored before the join, so that both sides are shuffled for it and a large group is split.
    return rows.join(settle(groups), ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id"))
        .alias("kept"), "text_sha256", "level", "name")
