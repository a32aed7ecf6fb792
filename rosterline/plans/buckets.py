"""A dimension kept in buckets of persons, of which a snapshot changes only some.

For each bucket a digest of what the last snapshot said of its persons is kept. Buckets whose
digest is the same have nothing to close and nothing to open, so only the others are read and
written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd2 import PERSON, compared, scd2_close_changed, scd2_new_versions
from ..schemas import TRACKED
from ..sources.tables import read, scratch, settle, stored_max, write, write_partitions
from ..sources.versions import commit, latest, open_version, stage_version
from .refresh import changed_rows

BUCKET = "bucket"
BUCKETS = 64


def bucket_of(person: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(person), F.lit(buckets)).cast("int")


def store_in_buckets(dim: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write a dimension by bucket of person."""
    write(dim.withColumn(BUCKET, bucket_of(PERSON, buckets)), path, [BUCKET],
          [PERSON, "valid_from"])


def snapshot_digests(snap: DataFrame, buckets: int = BUCKETS,
                     tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Per bucket the rows of a prepared snapshot and two sums of hashes of what is compared.

    The sums do not depend on the order of rows, and count repeated rows as often as they occur.
    """
    said = [PERSON, "hire_date", *[compared(a, a) for a in tracked]]
    hashes = [F.xxhash64(F.lit(seed), *said).cast("decimal(20,0)") for seed in (3, 29)]
    return snap.groupBy(bucket_of(PERSON, buckets).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(h).alias(f"digest_{i}") for i, h in enumerate(hashes)])


def apply_snapshot(spark: SparkSession, path: str, digests: str, snap: DataFrame, as_of: dt.date,
                   buckets: int = BUCKETS, tracked: Sequence[str] = TRACKED,
                   null_safe: bool = False, rehire: bool = False) -> list[int]:
    """Close and reopen versions of a stored dimension by a prepared snapshot.

    Returns the buckets that were written: those of which the snapshot says something else than
    the last one, all at first. ``digests`` keeps versions; the new one is committed at the end,
    so a run that stops before is made good by the next, as closing and reopening again changes
    nothing. Steps that use other lists (soft delete, leavers) are not part of this.
    """
    with scratch(spark):
        snap = settle(snap)
        staged = stage_version(snapshot_digests(snap, buckets, tracked), digests)
        after, before = open_version(spark, digests, staged), latest(spark, digests)
        if before is not None:
            after = changed_rows(open_version(spark, digests, before), after)
        changed = sorted(r[BUCKET] for r in after.select(BUCKET).distinct().collect())
        if changed:
            dim = read(spark, path).filter(F.col(BUCKET).isin(changed)).drop(BUCKET)
            part = snap.filter(bucket_of(PERSON, buckets).isin(changed))
            closed = settle(scd2_close_changed(dim, part, as_of, tracked, null_safe))
            result = settle(scd2_new_versions(
                closed, part, as_of, tracked, null_safe=null_safe, rehire=rehire,
                last_id=F.lit(stored_max(spark, path, "id"))))
            write_partitions(result.withColumn(BUCKET, bucket_of(PERSON, buckets)), path, BUCKET,
                             changed, [PERSON, "valid_from"])
    commit(spark, digests, staged)
    return changed
