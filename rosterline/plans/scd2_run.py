"""One run of the staff dimension: all steps in order."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.names import name_key
from ..operators.scd2 import (PERSON, apply_defaults, backfill, clamp_valid_to,
                              effective_manager, enrich, prepare_snapshot, scd2_close_changed,
                              scd2_new_entities, scd2_new_versions, scd2_soft_delete,
                              spread_termination)
from ..operators.spread import hot_keys_each
from ..schemas import LEAVERS, SNAPSHOT, STAFF_DIM
from ..sources.landing import typed
from ..sources.tables import settle


@dataclass(frozen=True)
class RunOptions:
    """What a run needs to know besides its tables."""

    as_of: dt.date
    exempt: str | None = None          # names the soft delete leaves alone
    segment_boss: str | None = None    # boss whose reports get the first default segment
    null_safe: bool = False            # changes from or to null count
    rehire: bool = False               # returning persons get a version
    full_overlap: bool = False         # containment counts in the effective boss
    hot_rows: int | None = None        # persons and bosses of more rows are split


def load_dim(raw: DataFrame) -> DataFrame:
    """Bring a stored or seed dimension to the schema; columns beyond it stay.

    The word 'NULL' and empty cells are null; what else cannot be read is an error, as the result
    replaces the history.
    """
    return typed(raw, STAFF_DIM)


def scd2_run(dim: DataFrame, snap: DataFrame, leavers: DataFrame, options: RunOptions,
             overrides: DataFrame | None = None) -> DataFrame:
    """The dimension after the day's snapshot and leavers list have been taken in.

    Both may come as text, as landed. Columns of the dimension beyond the schema stay; they are
    null in new versions.
    """
    as_of = options.as_of
    snap = prepare_snapshot(typed(snap, SNAPSHOT))
    leavers = typed(leavers, LEAVERS).withColumn(PERSON, name_key(PERSON))
    # Persons and bosses are counted once for all steps; a step adds a row per snapshot row at most.
    names = [PERSON, name_key("direct_report").alias("_boss")]
    hot, hot_bosses = hot_keys_each(dim.select(*names).unionByName(snap.select(*names)),
                                    [[PERSON], ["_boss"]], options.hot_rows)
    dim = scd2_new_entities(dim, snap, as_of, hot)
    dim = scd2_close_changed(dim, snap, as_of, null_safe=options.null_safe, hot=hot)
    # New versions and effective bosses read the dimension several times, so it is stored there.
    # The steps between them are all by person: one shuffle serves them.
    dim = scd2_new_versions(settle(dim), snap, as_of, null_safe=options.null_safe,
                            rehire=options.rehire, hot=hot)
    dim = scd2_soft_delete(dim, snap, as_of, options.exempt, hot)
    dim = backfill(dim, leavers, hot=hot)
    dim = clamp_valid_to(spread_termination(dim, hot))
    dim = effective_manager(settle(dim), options.full_overlap, hot_bosses)
    dim = apply_defaults(dim, overrides, options.segment_boss)
    return enrich(dim, snap, hot=hot)
