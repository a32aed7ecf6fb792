"""Steps that keep a staff dimension with history from daily snapshots.

All steps take the dimension as in ``schemas.STAFF_DIM`` and a snapshot from
:func:`prepare_snapshot`. ``as_of`` is the day of the run. ``hot`` takes a list of persons with
very many rows (see ``spread.hot_keys``), so that a chain of steps counts them only once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import fold_accents, name_key, null_if
from ..schemas import CARRIED, CRM_IDS, OPEN_END, TRACKED
from .cover import dense_keys, inside
from .dimview import INACTIVE
from .groups import with_group_values
from .ids import dense_ids, max_value
from .joins import DENSE, changed, ends_within, not_in, touching, update_from
from .spread import HotKeys, join_spread

PERSON = "person_name"
FROM_SNAPSHOT = (PERSON, *TRACKED, "hire_date")
# Attributes compared in a normalised form.
COMPARED = {"job_title": name_key, "area": fold_accents, "cost_center": fold_accents}


def prepare_snapshot(snap: DataFrame) -> DataFrame:
    """Clean names, fold accents, and turn the reports column into a 0/1 flag."""
    return snap.withColumns({
        PERSON: name_key(PERSON),
        "has_reports": F.when(F.col("has_reports") == "No", 0).otherwise(1),
        "area": fold_accents("area"),
        "cost_center": fold_accents("cost_center"),
        "direct_report": name_key("direct_report"),
    })


def compared(attribute: str, col: str) -> Column:
    return COMPARED.get(attribute, F.col)(col)


def _stamp_time(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("timestamp")


def _with_ids(rows: DataFrame, dim: DataFrame, order: Sequence[str],
              last_id: Column | None = None) -> DataFrame:
    """Give new rows the ids after the dimension's greatest, or ``last_id``, and its columns."""
    order = [*order, *[c for c in rows.columns if c not in order]]
    last_id = max_value(dim) if last_id is None else last_id
    return dense_ids(rows, order, last_id).select(*dim.columns)


def scd2_new_entities(dim: DataFrame, snap: DataFrame, as_of: dt.date,
                      hot: HotKeys | None = None) -> DataFrame:
    """Add a first version for every snapshot person the dimension does not know."""
    known = {
        **{c: F.col(c) for c in FROM_SNAPSHOT},
        "active": F.lit(1),
        "dead": F.lit(0),
        "valid_from": F.col("hire_date"),
        "valid_to": F.lit(OPEN_END),
        "tenure_no": F.lit(1),
        "updated_at": _stamp_time(as_of),
    }
    rows = not_in(snap, dim, [PERSON], hot=hot).select("person_no", *[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dim.schema.fields if f.name != "id"
    ])
    return dim.unionByName(_with_ids(rows, dim, ["person_no", PERSON]))


def _snapshot_ranges(snap: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """Least and greatest value of each attribute, and whether one is null, per person.

    One row per person whatever the snapshot holds. A version differs from some snapshot row
    exactly if, for some attribute, it differs from the least or the greatest value.
    """
    values = []
    for a in tracked:
        value = compared(a, a)
        values += [F.min(value).alias(f"_min_{a}"), F.max(value).alias(f"_max_{a}"),
                   F.bool_or(value.isNull()).alias(f"_void_{a}")]
    return snap.groupBy(PERSON).agg(*values)


def _differs(tracked: Sequence[str], null_safe: bool) -> Column:
    pairs = [(compared(a, a), F.col(f"_{edge}_{a}")) for a in tracked for edge in ("min", "max")]
    differs = changed(pairs)
    if null_safe:
        for a in tracked:
            differs |= F.when(F.col(a).isNull(), F.col(f"_min_{a}").isNotNull()).otherwise(
                F.coalesce(F.col(f"_void_{a}"), F.lit(False)))
    return differs


def scd2_close_changed(dim: DataFrame, snap: DataFrame, as_of: dt.date,
                       tracked: Sequence[str] = TRACKED, null_safe: bool = False,
                       hot: HotKeys | None = None) -> DataFrame:
    """Close open versions of active persons whose tracked attributes changed.

    A change from or to null counts with ``null_safe`` only.
    """
    joined = join_spread(dim, _snapshot_ranges(snap, tracked), [PERSON], "left", hot=hot)
    closing = (F.col("dead") == 0) & (F.col("active") == 1) & _differs(tracked, null_safe)
    return joined.withColumns({
        "dead": F.when(closing, 1).otherwise(F.col("dead")),
        "valid_to": F.when(closing, F.lit(as_of)).otherwise(F.col("valid_to")),
    }).select(*dim.columns)


def scd2_new_versions(dim: DataFrame, snap: DataFrame, as_of: dt.date,
                      tracked: Sequence[str] = TRACKED, carry: Sequence[str] = CARRIED,
                      null_safe: bool = False, rehire: bool = False,
                      hot: HotKeys | None = None, last_id: Column | None = None) -> DataFrame:
    """Open a version for persons whose versions are all closed and one of them differs.

    Attributes come from the snapshot, those in ``carry`` from the person's latest row. The
    hire date is the earliest, the tenure number and CRM ids are the greatest. With ``rehire``
    persons none of whose versions is active get one too, with the next tenure number. If ``dim``
    is a part of the dimension, ``last_id`` is the greatest id of the whole.
    """
    fresh = snap.select(PERSON, F.col("hire_date").alias("_new_hire_date"),
                        *[F.col(a).alias(f"_new_{a}") for a in tracked])
    joined = join_spread(dim, fresh, [PERSON], "inner", hot=hot)
    pairs = [(compared(a, a), compared(a, f"_new_{a}")) for a in tracked]
    joined = joined.withColumn("_changed", changed(pairs, null_safe))
    taken = F.col("_changed") | F.lit(rehire)
    new = [f"_new_{a}" for a in tracked]
    people = joined.groupBy(PERSON, *new).agg(
        F.min("dead").alias("_min_dead"),
        F.max("active").alias("_max_active"),
        F.bool_or("_changed").alias("_any_changed"),
        F.min("hire_date").alias("_hire_date"),
        F.max("_new_hire_date").alias("_new_hire_date"),
        F.max("tenure_no").alias("_tenure_no"),
        *[F.max(F.when(taken, F.col(c))).alias(c) for c in CRM_IDS],
        F.max_by(F.struct(*carry), F.struct("updated_at", "id")).alias("_latest"),
    )
    reopened = (F.col("_min_dead") == 1) & F.col("_any_changed")
    rehired = F.lit(rehire) & (F.col("_max_active") == 0)
    known = {
        PERSON: F.col(PERSON),
        **{a: F.col(f"_new_{a}") for a in tracked},
        **{c: F.col(c) for c in CRM_IDS},
        **{c: F.col(f"_latest.{c}") for c in carry},
        "hire_date": F.when(rehired, F.col("_new_hire_date")).otherwise(F.col("_hire_date")),
        "tenure_no": F.col("_tenure_no") + F.when(rehired, 1).otherwise(0),
        "active": F.lit(1),
        "dead": F.lit(0),
        "valid_from": F.lit(as_of),
        "valid_to": F.lit(OPEN_END),
        "updated_at": _stamp_time(as_of),
    }
    rows = people.filter(reopened | rehired).select(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dim.schema.fields if f.name != "id"
    ])
    # Ids are unique, and a group gives one row, so neither side repeats a row.
    return dim.unionByName(_with_ids(rows, dim, [PERSON], last_id))


def scd2_soft_delete(dim: DataFrame, snap: DataFrame, as_of: dt.date, exempt: str | None = None,
                     hot: HotKeys | None = None) -> DataFrame:
    """End open versions of active persons the snapshot no longer lists; they stay not dead.

    ``exempt`` is a LIKE pattern for names to leave alone.
    """
    listed = snap.select(PERSON).distinct().withColumn("_listed", F.lit(True))
    joined = join_spread(dim, listed, [PERSON], "left", hot=hot)
    gone = F.col("_listed").isNull() & (F.col("active") == 1) & (F.col("dead") == 0)
    if exempt is not None:
        gone &= ~F.col(PERSON).like(exempt)
    return joined.withColumns({
        "valid_to": F.when(gone, F.lit(as_of)).otherwise(F.col("valid_to")),
        "active": F.when(gone, 0).otherwise(F.col("active")),
        "updated_at": F.when(gone, _stamp_time(as_of)).otherwise(F.col("updated_at")),
    }).select(*dim.columns)


def backfill(dim: DataFrame, src: DataFrame, key: str = PERSON, col: str = "termination_date",
             sentinel: str | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Fill ``col`` of inactive persons from another list, where it is null or the sentinel.

    If the list has several values for a key, the greatest is taken.
    """
    values = src.groupBy(key).agg(F.max(col).alias("_value"))
    current = F.col(col) if sentinel is None else null_if(col, sentinel)
    missing = (F.col("active") == 0) & current.isNull()
    return (
        join_spread(dim, values, [key], "left", hot=hot)
        .withColumn(col, F.when(missing, F.coalesce("_value", col)).otherwise(F.col(col)))
        .select(*dim.columns)
    )


def spread_by_group(dim: DataFrame, group: Sequence[str], values: dict[str, Column],
                    where: Column | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Write group aggregates over the rows that pass ``where`` to all rows of the group.

    Rows with a null in the group columns keep their values.
    """
    named = {f"_group_{c}": v for c, v in values.items()}
    grouped = reduce(and_, (F.col(c).isNotNull() for c in group))
    return (
        with_group_values(dim, group, named, where, hot=hot)
        .withColumns({c: F.coalesce(F.when(grouped, F.col(f"_group_{c}")), c) for c in values})
        .select(*dim.columns)
    )


def spread_termination(dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Give all versions of a tenure its last termination date and its activity."""
    return spread_by_group(
        dim, [PERSON, "tenure_no"],
        {"active": F.min(F.when(F.col("termination_date").isNotNull(), F.col("active"))),
         "termination_date": F.max("termination_date")}, hot=hot)


def clamp_valid_to(dim: DataFrame) -> DataFrame:
    """Let no version outlast the termination date."""
    return dim.withColumn("valid_to", F.least("valid_to", "termination_date"))


def _boss_periods(dim: DataFrame) -> DataFrame:
    """Days on which a boss counts, by kind: 1 open version, 2 current start, 3 former tenure.

    Only the latest end per start day is kept, which holds every day the others hold. So a boss
    has at most two rows per calendar day and one more.
    """
    boss = name_key(PERSON).alias("_boss")
    in_office = dim.filter((F.col("dead") == 0) & (F.col("active") == 1))
    name = F.min(PERSON).alias("_name")
    open_versions = in_office.groupBy(boss, "valid_from").agg(
        F.max("valid_to").alias("_to"), name).select(
        "_boss", F.lit(1).alias("_kind"), F.col("valid_from").alias("_from"), "_to", "_name")
    current = in_office.groupBy(boss).agg(F.max("valid_from").alias("_from"), name).select(
        "_boss", F.lit(2).alias("_kind"), "_from", F.col("_from").alias("_to"), "_name")
    former = (
        dim.filter(F.col("active") == 0).groupBy(boss, "tenure_no")
        .agg(F.min("valid_from").alias("_from"), F.max("valid_to").alias("_to"), name)
        .groupBy("_boss", "_from").agg(F.max("_to").alias("_to"), F.min("_name").alias("_name"))
        .select("_boss", F.lit(3).alias("_kind"), "_from", "_to", "_name")
    )
    return open_versions.unionByName(current).unionByName(former)


def _answering(versions: DataFrame, periods: DataFrame, full_overlap: bool,
               hot: HotKeys | None, dense: int) -> DataFrame:
    """Versions (id, _boss, valid_from, valid_to) with the boss's periods that count for them.

    A boss with many periods and many reports is looked up by pieces of the calendar.
    """
    on, days, boss_days = ["_boss"], ("valid_from", "valid_to"), ("_from", "_to")
    kind = F.col("_kind")
    touches = ends_within(*map(F.col, days), *map(F.col, boss_days), full_overlap)
    counts = F.when(kind == 2, F.col("_from").between(*map(F.col, days))).otherwise(touches)
    many = dense_keys(periods, on, dense)
    if many is not None:
        many = dense_keys(versions.join(many, on, "left_semi"), on, dense)
    if many is None:
        return join_spread(versions, periods, on, "inner", counts, hot=hot)
    few = join_spread(versions.join(many, on, "left_anti"), periods, on, "inner", counts, hot=hot)
    mine, theirs = (x.join(many, on, "left_semi") for x in (versions, periods))
    pairs = touching(mine, theirs.filter(kind != 2), on, days, boss_days, full_overlap)
    starts = inside(theirs.filter(kind == 2), mine, on, "_from", *days)
    return few.unionByName(pairs).unionByName(starts)


def effective_manager(dim: DataFrame, full_overlap: bool = False,
                      hot_bosses: HotKeys | None = None, dense: int = DENSE) -> DataFrame:
    """Fill ``effective_boss``: who answered for a person during a version.

    The named boss if an open version of theirs touches this one; else the boss if their current
    version starts within it; else the boss if a former tenure of theirs touches it; else
    'Inactive'.
    """
    versions = dim.select("id", name_key("direct_report").alias("_boss"),
                          "valid_from", "valid_to")
    best = (
        _answering(versions, _boss_periods(dim), full_overlap, hot_bosses, dense)
        .groupBy("id").agg(F.min(F.struct("_kind", "_name")).alias("_best"))
    )
    boss = (F.when(F.col("_best._kind") == 2, F.col("_best._name"))
            .when(F.col("_best").isNotNull(), F.col("direct_report"))
            .otherwise(F.lit(INACTIVE)))
    return (dim.join(best, "id", "left")
            .withColumn("effective_boss", F.coalesce(boss, "effective_boss"))
            .select(*dim.columns))


def apply_defaults(dim: DataFrame, overrides: DataFrame | None = None,
                   segment_boss: str | None = None, with_boss: str = "SMB",
                   without_boss: str = "Mid Market") -> DataFrame:
    """Fill the second country and the segment.

    ``overrides`` (id, country_2) come first; then a missing second country takes the country.
    A missing segment depends on whether the boss is ``segment_boss``.
    """
    if overrides is not None:
        dim = update_from(dim, overrides, ["id"], ["country_2"])
    dim = dim.withColumn("country_2", F.coalesce("country_2", "country"))
    if segment_boss is not None:
        reports = F.col("direct_report") == segment_boss
        default = F.when(reports, with_boss).when(~reports, without_boss)
        dim = dim.withColumn("segment", F.coalesce(F.col("segment"), default))
    return dim


def enrich(dim: DataFrame, src: DataFrame, key: str = PERSON,
           cols: Sequence[str] = ("birth_date",), hot: HotKeys | None = None) -> DataFrame:
    """Fill missing ``cols`` from another list; of several values the greatest is taken."""
    values = src.groupBy(key).agg(*[F.max(c).alias(f"_src_{c}") for c in cols])
    return (
        join_spread(dim, values, [key], "left", hot=hot)
        .withColumns({c: F.coalesce(c, f"_src_{c}") for c in cols})
        .select(*dim.columns)
    )
