"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import default_shared_dir, settle

__all__ = ["doc_hash", "fold_case", "id_remainder", "settle", "ship", "tidy", "unused"]

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def fold_case(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text.

    Of a text with other characters only the runs of A-Z are lower-cased, as ``lower`` would
    change others too; ``translate`` looks up every character and takes twice as long.
    """
    given = F.coalesce(text, F.lit(""))
    runs = F.regexp_extract_all(given, F.lit("[A-Z]+|[^A-Z]+"), F.lit(0))
    folded = F.transform(runs, lambda run: F.when(
        (run >= "A") & (run < "["), F.lower(run)).otherwise(run))
    return F.when(F.octet_length(given) == F.length(given), F.lower(given)) \
        .otherwise(F.array_join(folded, ""))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def doc_hash(doc_id: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes that tell documents apart, also such as share an id by mistake.

    Rows equal in id and text have equal hashes: they count as one document given twice.
    """
    return [F.xxhash64(F.lit(seed), doc_id, text) for seed in (11, 23)]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; set the shared folder
    of a local session that has none; keep Arrow batches of long texts small.

    A cluster has the package installed, or it is given with --py-files; this serves sessions
    whose workers start in another folder.
    """
    default_shared_dir(spark)
    if spark.conf.get(BATCH_SETTING, None) in (None, "10000"):  # the default
        spark.conf.set(BATCH_SETTING, "1000")
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over batches that gives its memory back when its task ends.

    Python workers are kept for later tasks, beside whatever runs in the executor by then.
    """
    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return to_the_end
