"""The registered queries: one per operator, over tables derived from the given ones."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions import (age, classify, fold_accents, fractional_months, month_diff,
                                  name_key, null_if, weeks_between)
from rosterline.operators import (apply_defaults, backfill, clamp_valid_to,
                                  conflicting_owners, current_manager,
                                  daily_manager, daily_roster, dense_ids, dim_view,
                                  duplicate_days, effective_manager, enrich,
                                  first_role, join_overlapping, join_range, join_spread,
                                  join_valid_at, latest_rows, latest_version, manager_periods,
                                  matched, max_value, not_in, open_days, overlap_periods,
                                  prepare_snapshot, ranked_versions, scd2_close_changed, scd2_new_entities,
                                  scd2_new_versions, scd2_soft_delete, spread_termination,
                                  subteam, subteam_active, tenure_metrics, with_group_values)
from rosterline.plans import (ContactTables, RunOptions, StampTables, activity_analysis,
                              activity_job, adjusted_date, apply_snapshot, contact_analysis,
                              load_dim, manager_job, scd2_run, stamp_activities,
                              store_in_buckets, unify_activities, view_job)
from rosterline.schemas import COMPANY, SNAPSHOT, TRACKED
from rosterline.sources import (clean_table, default_shared_dir, land_tables, land_typed,
                                new_version, read, read_first, read_landed, read_rejects,
                                read_table, read_version, register, save_table, scratch_path,
                                settle, staged_overwrite, stored_max, version_path, write,
                                write_version)

from .inputs import AS_OF, FEEDS, ROLE_AREAS, ROLE_TITLES, RUN_DAY, Inputs

EXEMPT = "Supplier 000000003%"
SEGMENT_BOSS = "Supplier 000000001"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
Build = Callable[[Inputs], DataFrame]


def query(name: str) -> Callable[[Build], Build]:
    """Register a query under a name."""
    def register(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            default_shared_dir(spark)
            return build(Inputs(spark, folder))

        QUERIES[name] = run
        return build
    return register


def view(t: Inputs) -> DataFrame:
    return dim_view(t.staff, AS_OF)


def stamp_tables(t: Inputs) -> StampTables:
    return StampTables(t.calendar, view(t), t.cohorts, t.dispositions)


def overrides(t: Inputs) -> DataFrame:
    return t.staff.filter(F.col("country") == "N7").select("id", F.lit("N99").alias("country_2"))


def snap(t: Inputs) -> DataFrame:
    return prepare_snapshot(t.snapshot)


# --- dimension with history ---------------------------------------------------------------

@query("scd2_insert")
def insert(t):
    return scd2_new_entities(t.staff, snap(t), RUN_DAY)


@query("scd2_close")
def close(t):
    return scd2_close_changed(t.staff, snap(t), RUN_DAY)


@query("scd2_version")
def version(t):
    return scd2_new_versions(settle(close(t)), snap(t), RUN_DAY)


@query("scd2_delete")
def delete(t):
    return scd2_soft_delete(t.staff, snap(t), RUN_DAY, EXEMPT)


@query("scd2_backfill")
def fill_termination(t):
    leavers = t.leavers.withColumn("person_name", name_key("person_name"))
    return backfill(t.dim, leavers, col="termination_raw", sentinel="NULL")


@query("scd2_spread")
def spread(t):
    return spread_termination(t.staff)


@query("scd2_clamp")
def clamp(t):
    return clamp_valid_to(t.staff)


@query("effective_manager")
def effective(t):
    return effective_manager(t.staff)


@query("default_cascade")
def defaults(t):
    return apply_defaults(t.staff, overrides(t), SEGMENT_BOSS)


@query("enrich")
def add_birth(t):
    return enrich(t.staff, snap(t))


@query("scd2_run")
def whole_run(t):
    options = RunOptions(RUN_DAY, exempt=EXEMPT, segment_boss=SEGMENT_BOSS)
    return scd2_run(t.staff, t.snapshot, t.leavers, options, overrides(t))


@query("scd2_run_rehire")
def whole_run_with_rehires(t):
    """The run over persons with several tenures, some of whom come back."""
    options = RunOptions(RUN_DAY, exempt=EXEMPT, segment_boss=SEGMENT_BOSS, rehire=True)
    return scd2_run(t.tenured, t.snapshot, t.leavers, options, overrides(t))


@query("scd2_spread_tenures")
def spread_tenures(t):
    return spread_termination(t.tenured)


@query("effective_manager_tenures")
def effective_tenures(t):
    return effective_manager(t.tenured)


def _as_snapshot(dim: DataFrame) -> DataFrame:
    """What a snapshot says that agrees with all open versions of active persons."""
    return dim.filter((F.col("dead") == 0) & (F.col("active") == 1)).select(
        "person_name", *TRACKED, "hire_date")


@query("scd2_changed_buckets")
def changed_buckets(t):
    """A stored dimension after a snapshot that says of one person in ten something new: only
    their buckets are read and written."""
    folder = scratch_path(t.spark, "dimension")
    path, digests = f"{folder}/buckets", f"{folder}/digests"
    store_in_buckets(t.staff, path)
    same, new = _as_snapshot(t.staff), F.col("person_no") % 10 == 3
    later = snap(t).filter(new).select(*same.columns)
    rest = same.join(snap(t).filter(new).select("person_name"), "person_name", "left_anti")
    apply_snapshot(t.spark, path, digests, same, RUN_DAY)
    apply_snapshot(t.spark, path, digests, rest.unionByName(later), RUN_DAY)
    return read(t.spark, path).drop("bucket")


@query("scd2_run_text")
def whole_run_as_landed(t):
    """The run over a seed, a snapshot and leavers of nothing but text, as landed.

    The seed has a column that the schema does not know, and the word NULL for what is missing.
    """
    def text(df: DataFrame, missing: str) -> DataFrame:
        return df.select([F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c)
                          if kind != "string" else F.col(c) for c, kind in df.dtypes])

    seed = text(t.staff.withColumn("note", F.concat(F.lit("note "), "id")), "NULL")
    leavers = t.leavers.select("person_name", F.col("termination_raw").alias("termination_date"))
    options = RunOptions(RUN_DAY, exempt=EXEMPT, segment_boss=SEGMENT_BOSS)
    return scd2_run(load_dim(seed), text(t.snapshot, ""), leavers, options, overrides(t))


@query("default_cascade_repeated")
def defaults_of_repeated_overrides(t):
    """Ids with two overrides: the greater one is taken, and no version is multiplied."""
    twice = overrides(t).unionByName(overrides(t).withColumn("country_2", F.lit("N11")))
    return apply_defaults(t.staff, twice, SEGMENT_BOSS)


@query("owner_conflicts")
def owners_of_several(t):
    return conflicting_owners(t.staff.withColumn("owner_id", F.col("owner_id") % 10))


# --- dimension view -----------------------------------------------------------------------

@query("dim_view")
def staff_view(t):
    return view(t)


@query("classify_role")
def role_class(t):
    return t.staff.select("id", "job_title", "area", "valid_to", 
                          classify().alias("job_class"))


@query("classify_titles")
def role_class_of_all_titles(t):
    """Every version under one of many titles and areas; some end before the rule's change."""
    def pick(values, index):
        return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))

    titled = t.staff.select(
        "id", pick(ROLE_TITLES, F.col("id")).alias("job_title"),
        pick(ROLE_AREAS, F.floor(F.col("id") / 25)).alias("area"), "valid_to")
    return titled.withColumn("job_class", classify())


@query("subteam")
def teams(t):
    title, name = "job_title", F.col("person_name")
    return t.staff.select(
        "id", subteam(title, name, F.col("direct_report")).alias("subteam"),
        subteam_active(title, name, F.col("active"), F.col("effective_boss"))
        .alias("subteam_active"))


@query("age")
def age_in_years(t):
    return t.staff.select("id", "birth_date", age(F.col("birth_date"), F.lit(AS_OF)).alias("age"))


@query("first_role")
def first_title(t):
    versions = t.staff.select("id", "person_name", "job_title", "valid_from", "hire_date")
    return first_role(versions, role="job_title")


@query("latest_version")
def newest(t):
    return latest_version(view(t)).select("id", "person_name", "rank_id", "valid_from",
                                          "valid_to")


# --- hierarchy ----------------------------------------------------------------------------

@query("current_manager")
def manager_now(t):
    return current_manager(view(t))


@query("daily_roster")
def roster(t):
    return daily_roster(settle(view(t)), t.calendar, AS_OF)


@query("daily_manager")
def manager_by_day(t):
    return daily_manager(view(t), t.calendar, AS_OF)


@query("daily_roster_workdays")
def roster_on_workdays(t):
    return daily_roster(settle(view(t)), t.workdays, AS_OF)


@query("daily_manager_workdays")
def manager_on_workdays(t):
    return daily_manager(view(t), t.workdays, AS_OF)


# --- activities and contacts --------------------------------------------------------------

@query("unify_activities")
def activities(t):
    return unify_activities(t.feeds)


@query("stamp_activities")
def stamp(t):
    return stamp_activities(unify_activities(t.feeds), stamp_tables(t))


@query("activity_analysis")
def analysis(t):
    return activity_analysis(unify_activities(t.feeds), stamp_tables(t))


@query("tenure_metrics")
def tenure(t):
    """Both ways of counting, on every activity and the version of its owner."""
    facts = unify_activities(t.feeds).select("activity_id", "owner_id", "activity_type",
                                             "activity_date")
    staff = t.staff.select("owner_id", "hire_date", "valid_from", "valid_to")
    met = join_valid_at(facts, staff, ["owner_id"], "activity_date",
                        spread_by=["activity_id"]).drop("valid_to")
    met = tenure_metrics(met, "activity_date", "hire_date", "activity_type", meeting_rule=True)
    return tenure_metrics(met, "activity_date", "hire_date", "activity_type", "days", "rounded",
                          meeting_rule=True, prefix="plain_")


@query("adjusted_date")
def adjusted(t):
    staff = latest_version(ranked_versions(t.staff)).select("owner_id", "hire_date")
    contacts = t.contacts.select("contact_id", "owner_id",
                                 F.col("created_at").cast("date").alias("created_date"))
    owned = join_spread(contacts, staff, ["owner_id"], "left", spread_by=["contact_id"])
    return adjusted_date(owned, "created_date", "hire_date", t.calendar)


@query("contact_analysis")
def contacts(t):
    staff = settle(view(t))
    managers = settle(manager_periods(staff, t.calendar, AS_OF))
    return contact_analysis(t.contacts, ContactTables(
        t.companies, t.calendar, staff, t.cohorts, managers))


@query("duplicate_keys")
def duplicates(t):
    """Person days met twice: versions of the raw dimension share their boundary days."""
    versions = t.staff.select("person_name", "valid_from", "valid_to")
    return duplicate_days(open_days(versions, t.calendar, AS_OF), ["person_name"], "first_day",
                          "last_day", t.calendar)


@query("duplicate_workdays")
def duplicate_workdays(t):
    """Days of many shifts of one owner, of a calendar with holes."""
    return duplicate_days(t.shifts, ["owner_id"], "valid_from", "valid_to", t.workdays)


@query("overlap_periods")
def overlaps(t):
    """Periods in which ten or more shifts of an owner run at once."""
    return overlap_periods(t.shifts, ["owner_id"], "valid_from", "valid_to", 10)


def _earlier(staff: DataFrame) -> DataFrame:
    """The staff as if some persons' last versions had other bosses and titles then."""
    late = F.col("valid_from") >= F.lit("1998-03-01").cast("date")
    moved = (F.col("owner_id") % 10 == 3) & late
    return staff.withColumns({
        "direct_report": F.when(moved, "Supplier 000000001").otherwise(F.col("direct_report")),
        "job_title": F.when(moved, "Key Account Manager").otherwise(F.col("job_title"))})


def _jobs_folder(t: Inputs, *names: str) -> dict[str, str]:
    folder = scratch_path(t.spark, "jobs")
    return {n: f"{folder}/{n}" for n in names}


@query("daily_manager_refreshed")
def managers_refreshed(t):
    """Daily managers made from an earlier dimension, then only the changed years again."""
    path = _jobs_folder(t, "dim", "view", "calendar", "managers", "periods")
    write(t.calendar, path["calendar"])
    for dim in (_earlier(t.staff), t.staff):
        write_version(dim, path["dim"])
        view_job(t.spark, path["dim"], path["view"], AS_OF)
        manager_job(t.spark, path["view"], path["calendar"], path["managers"], path["periods"],
                    AS_OF)
    return read(t.spark, path["managers"]).drop("yyyy")


@query("activity_analysis_refreshed")
def activities_refreshed(t):
    """Stamped activities made with an earlier view, then only the years it changed in."""
    path = _jobs_folder(t, "dim", "view", "calendar", "cohorts", "dispositions", "activities",
                        *FEEDS)
    for name, df in (("calendar", t.calendar), ("cohorts", t.cohorts),
                     ("dispositions", t.dispositions), *zip(FEEDS, t.feeds)):
        write(df, path[name])
    used = None
    for dim in (_earlier(t.staff), t.staff):
        write_version(dim, path["dim"])
        view_job(t.spark, path["dim"], path["view"], AS_OF)
        used, _ = activity_job(
            t.spark, [path[f] for f in FEEDS], path["view"], path["calendar"], path["cohorts"],
            path["dispositions"], path["activities"], since=used)
    return read(t.spark, path["activities"])


# --- tables -------------------------------------------------------------------------------

@query("scan_parquet")
def scan(t):
    return read(t.spark, f"{t.folder}/orders.parquet").filter(
        F.col("o_totalprice") > 250000).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("scan_fallback")
def fallback(t):
    """The history is not there, so the seed is read."""
    paths = [f"{t.folder}/customer_history.parquet", f"{t.folder}/customer.parquet"]
    return read_first(t.spark, paths).select("c_custkey", "c_name", "c_nationkey")


@query("write_roundtrip")
def roundtrip(t):
    """A table written by year, then replaced by a result of reading it."""
    path = scratch_path(t.spark, "activities")
    facts = unify_activities(t.feeds).select("activity_id", "owner_id", "activity_date",
                                             F.year("activity_date").alias("yyyy"))
    write(facts, path, ["yyyy"], sort_by=["activity_id"])
    later = read(t.spark, path).withColumn("activity_date", F.date_add("activity_date", 1))
    staged_overwrite(later, path, f"{path}-staging", ["yyyy"])
    return read(t.spark, path)


@query("history_versions")
def history(t):
    """A history written twice, each time from itself, and then by a run that stopped before its
    commit: the last committed version, with what the one before it said."""
    path = scratch_path(t.spark, "history")
    write_version(t.staff, path)
    gone = F.col("country") == "N7"
    write_version(read(t.spark, path).withColumn(
        "active", F.when(gone, 0).otherwise(F.col("active"))), path)
    stopped = new_version(t.spark, path)
    read(t.spark, path).filter(gone).write.parquet(version_path(path, stopped))
    before = read_version(t.spark, path, 1).select("id", F.col("active").alias("active_before"))
    return read_first(t.spark, [path, f"{t.folder}/supplier.parquet"]).select(
        "id", "person_name", "active", "valid_to").join(before, "id")


@query("land_with_rejects")
def land_rejects(t):
    """Customers landed from text of which some cannot be read: all rows, with what was wrong."""
    c = F.col("c_custkey")
    raw = t.table("customer").select(
        F.when(c % 13 == 5, F.concat(F.lit("no "), c)).otherwise(c.cast("string"))
        .alias("company_id"),
        F.when(c % 7 == 0, "NULL").when(c % 11 == 4, "?").otherwise((c * 2).cast("string"))
        .alias("row_tag"), F.col("c_mktsegment").alias("segment"))
    path = scratch_path(t.spark, "landed")
    land_typed(raw, COMPANY, path, most=0.5, required=("company_id",))
    bad = F.array_join(F.transform("_bad", lambda r: F.concat(
        r["column"], F.lit("="), r["value"])), ", ")
    return read_landed(t.spark, path).withColumn("wrong", F.lit("")).unionByName(
        read_rejects(t.spark, path).withColumn("wrong", bad).drop("_bad"))


@query("stored_max")
def greatest_stored(t):
    """Greatest ids of stored tables, from the footers of their files."""
    path = scratch_path(t.spark, "orders")
    write(t.table("orders").select("o_orderkey", "o_orderstatus", "o_custkey"), path,
          ["o_orderstatus"])
    found = [("orders", stored_max(t.spark, path, "o_orderkey")),
             ("customers", stored_max(t.spark, f"{t.folder}/customer.parquet", "c_custkey"))]
    return t.spark.createDataFrame(found, "name string, greatest long")


@query("land_tables")
def land(t):
    """Tabs exported as CSV, landed without the excluded one and without the seed."""
    src, dst = scratch_path(t.spark, "tabs"), scratch_path(t.spark, "landed")
    for tab, df in (("snapshot", t.snapshot), ("leavers", t.leavers), ("seed", t.dim),
                    ("notes", t.table("nation"))):
        (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{src}/{tab}"))
    land_tables(t.spark, src, dst, exclude=["notes"], seed="seed",
                history=f"{t.folder}/supplier.parquet", schemas={"snapshot": SNAPSHOT})
    return read(t.spark, f"{dst}/snapshot.parquet").join(
        read(t.spark, f"{dst}/leavers.parquet").select(
            "person_name", F.col("termination_raw").alias("left_on")), "person_name", "left")


@query("land_quoted")
def land_quoted_cells(t):
    """Cells with commas, quotes and line breaks."""
    src, dst = scratch_path(t.spark, "tabs"), scratch_path(t.spark, "landed")
    remark = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nnext line'))
    customers = t.table("customer").select("c_custkey", remark.alias("remark"))
    customers.write.options(header=True, escape='"', quoteAll=True).csv(f"{src}/remarks")
    land_tables(t.spark, src, dst, schemas={"remarks": customers.schema})
    return read(t.spark, f"{dst}/remarks.parquet")


@query("catalog_roundtrip")
def through_the_catalog(t):
    """A table saved by name, read by name, and named again for SQL."""
    name = f"orders_{uuid.uuid4().hex}"
    save_table(t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), name)
    register(read_table(t.spark, name), "named_orders")
    return t.spark.sql("select o_orderstatus, count(*) as orders, "
                       "cast(sum(o_custkey) as long) as customers "
                       "from named_orders group by o_orderstatus")


@query("clean_table")
def clean(t):
    mixed = t.activities.select(
        "activity_id", "activity_type", "disposition_id",
        F.when(F.col("activity_id") % 3 == 0, F.concat(F.lit("n"), "activity_id"))
        .otherwise(F.col("activity_id").cast("string")).alias("number_text"))
    return clean_table(mixed, int_columns=["number_text"])


@query("surrogate_ids")
def ids(t):
    customers = t.table("customer").select("c_custkey", "c_mktsegment")
    return dense_ids(customers, ["c_mktsegment", "c_custkey"], max_value(customers, "c_custkey"),
                     "new_id")


# --- projections and predicates -----------------------------------------------------------

@query("project")
def project(t):
    a = t.staff.alias("a")
    return (
        a.select("a.id", F.col("a.person_name").alias("person"), "a.job_title", "a.area",
                 "a.valid_from")
        .withColumns({"dead": F.lit(0), "valid_to": F.lit(dt.date(2100, 12, 31))})
        .withColumnRenamed("job_title", "title").drop("area")
        .select("valid_from", "valid_to", "id", "person", "title", "dead"))


@query("flags")
def flags(t):
    soon = F.col("last_contacted_at") <= F.date_add(F.col("created_at").cast("date"), 5)
    facts = t.contacts.select("contact_id", "company_id",
                              F.when(soon, 1).otherwise(0).alias("contacted_soon"))
    return join_spread(facts, t.companies, ["company_id"], "left",
                       spread_by=["contact_id"]).select(
        "contact_id", "contacted_soon",
        F.when(F.col("row_tag").isNotNull(), 1).otherwise(0).alias("has_row_tag"))


@query("null_default")
def null_default(t):
    return t.staff.select(
        "id", F.coalesce("segment", F.lit("none")).alias("segment"),
        F.coalesce("country_2", "country").alias("country_2"))


@query("predicates")
def predicates(t):
    title, area = F.col("job_title"), F.col("area")
    tests = {
        "is_sales_manager": title.ilike("%sales%manager%"),
        "not_key": ~title.ilike("%key%"),
        "other_gender": F.col("gender") != "F",
        "ended": F.col("valid_to").isNotNull() & (F.col("dead") == 1),
        "in_1997": F.col("valid_from").between(dt.date(1997, 1, 1), dt.date(1997, 12, 31)),
        "some_titles": title.isin("VP Sales", "SDR Intern"),
        "other_areas": ~area.isin("Sales", "growth"),
        "no_termination": null_if("termination_raw", "NULL").isNull(),
    }
    return t.dim.filter((F.col("has_reports") == 1) | F.col("segment").isNull()).select(
        "id", *[test.cast("int").alias(name) for name, test in tests.items()])


# --- joins --------------------------------------------------------------------------------

@query("join_left")
def left(t):
    facts = unify_activities(t.feeds).select("activity_id", "disposition_id", "activity_date")
    return (
        facts.join(t.dispositions.withColumnRenamed("id", "disposition_id"), "disposition_id",
                   "left")
        .join(t.calendar.withColumnRenamed("dte", "activity_date"), "activity_date", "left"))


@query("join_anti")
def anti(t):
    return not_in(snap(t), t.staff, ["person_name"]).select("person_no", "person_name")


@query("join_inner")
def inner(t):
    return matched(t.staff.select("id", "person_name"),
                   snap(t).select("person_name", "person_no"), ["person_name"])


@query("join_normalised")
def normalised(t):
    left_on = t.leavers.select(name_key("person_name").alias("person_name"), "termination_raw")
    return matched(t.staff.select("id", "person_name"), left_on, ["person_name"])


@query("join_multikey")
def multikey(t):
    facts = t.activities.select("activity_id", "owner_id",
                                F.col("activity_at").cast("date").alias("dte"))
    contacts = t.contacts.select("owner_id", F.col("created_at").cast("date").alias("dte"),
                                 "lead_label")
    counts = contacts.groupBy("owner_id", "dte").agg(
        F.count(F.lit(1)).alias("contacts"), F.max("lead_label").alias("lead_label"))
    return join_spread(facts, counts, ["owner_id", "dte"], "inner", spread_by=["activity_id"])


@query("join_point_in_interval")
def point_in_interval(t):
    facts = unify_activities(t.feeds).select("activity_id", "owner_id", "activity_date")
    staff = t.staff.select("id", "owner_id", "valid_from", "valid_to")
    return join_valid_at(facts, staff, ["owner_id"], "activity_date", spread_by=["activity_id"])


@query("join_interval_overlap")
def overlap(t):
    a = t.staff.select("id", name_key("direct_report").alias("boss"), "valid_from", "valid_to")
    b = t.staff.select(F.col("id").alias("boss_id"), name_key("person_name").alias("boss"),
                       F.col("valid_from").alias("boss_from"), F.col("valid_to").alias("boss_to"))
    return join_overlapping(a, b, ["boss"], ("valid_from", "valid_to"), ("boss_from", "boss_to"))


@query("join_point_in_shifts")
def point_in_shifts(t):
    """Owners of very many versions: shifts that run on the day of every ninth contact."""
    facts = t.contacts.filter(F.col("contact_id") % 9 == 0).select(
        "contact_id", (F.col("owner_id") % 2).alias("owner_id"),
        F.col("created_at").cast("date").alias("created_date"))
    return join_valid_at(facts, t.shifts, ["owner_id"], "created_date")


def _some_shifts(t: Inputs, prefix: str) -> DataFrame:
    return t.shifts.filter(F.col("shift_id") % 5 == 0).select("owner_id", *[
        F.col(c).alias(prefix + c) for c in ("shift_id", "valid_from", "valid_to")])


@query("join_shifts_overlap")
def shifts_overlap(t):
    """Very many intervals of an owner with each other: ends within, one-sided."""
    return join_overlapping(_some_shifts(t, ""), _some_shifts(t, "other_"), ["owner_id"],
                            ("valid_from", "valid_to"), ("other_valid_from", "other_valid_to"))


@query("join_shifts_full_overlap")
def shifts_full_overlap(t):
    return join_overlapping(_some_shifts(t, ""), _some_shifts(t, "other_"), ["owner_id"],
                            ("valid_from", "valid_to"), ("other_valid_from", "other_valid_to"),
                            full_overlap=True)


@query("effective_manager_by_pieces")
def effective_by_pieces(t):
    """Every boss of more than one period looked up as bosses of very many are."""
    return effective_manager(t.staff, dense=1)


@query("join_range")
def by_range(t):
    facts = unify_activities(t.feeds).select("activity_id", "activity_date")
    return join_range(facts, t.cohorts, "activity_date", "start_date", "end_date",
                      spread_by=["activity_id"])


@query("join_agg")
def with_aggregate(t):
    bosses = (t.staff.filter((F.col("dead") == 0) & (F.col("active") == 1))
              .groupBy(F.col("person_name").alias("direct_report"))
              .agg(F.count(F.lit(1)).alias("versions"), F.max("valid_from").alias("newest")))
    return join_spread(t.staff.select("id", "direct_report"), bosses, ["direct_report"], "left")


@query("latest_row")
def latest(t):
    rows = t.staff.select("id", "person_name", "job_title", "updated_at")
    one = latest_rows(rows, ["person_name"], "updated_at", "id")
    tied = latest_rows(rows, ["job_title"], "updated_at", keep_ties=True)
    return one.withColumn("kind", F.lit("one")).unionByName(
        tied.withColumn("kind", F.lit("tied")))


# --- aggregates, windows, order, sets -----------------------------------------------------

@query("agg_basic")
def aggregate(t):
    return t.staff.groupBy("area").agg(
        F.count(F.lit(1)).alias("versions"), F.max("updated_at").alias("last_update"),
        F.min("valid_from").alias("first_day"), F.max("valid_to").alias("last_day"),
        F.max("id").alias("top_id"))


@query("agg_expr")
def aggregate_by_expression(t):
    flag = F.when(F.col("has_reports") == "No", 0).otherwise(1)
    return t.snapshot.groupBy(
        fold_accents("area").alias("area"), flag.alias("reports"), "job_title").agg(
        F.max(name_key("person_name")).alias("last_name"), F.count(F.lit(1)).alias("people"))


@query("distinct")
def distinct(t):
    return t.staff.select("job_title", "area", "country").distinct()


@query("window_rank")
def rank(t):
    return ranked_versions(t.staff).select("id", "person_name", "rank_id", "reverse_rank_id")


@query("window_minmax")
def minmax(t):
    return with_group_values(
        t.staff.select("id", "person_name", "dead", "hire_date", "tenure_no"), ["person_name"],
        {"min_dead": F.min("dead"), "first_hire": F.min("hire_date"),
         "last_tenure": F.max("tenure_no")})


@query("sort")
def sort(t):
    return t.staff.select("person_name", "valid_from", "id").orderBy("person_name", "valid_from")


@query("limit")
def preview(t):
    return t.activities.select("activity_id", "activity_type").orderBy("activity_id").limit(5)


@query("union_all")
def union_all(t):
    return t.staff.select("person_name", "job_title").unionByName(
        snap(t).select("job_title", "person_name"))


@query("union_distinct")
def union_distinct(t):
    return t.staff.select("person_name", "area").unionByName(
        snap(t).select("person_name", "area")).distinct()


# --- scalar functions ---------------------------------------------------------------------

@query("scalars_string")
def strings(t):
    name = F.col("person_name")
    return t.snapshot.select(
        "person_no", F.trim(name).alias("trimmed"), name_key(name).alias("name_key"),
        fold_accents("area").alias("folded"), F.lower(name).alias("low"),
        F.upper("area").alias("high"))


@query("scalars_cast")
def casts(t):
    return t.dim.select(
        "id", F.col("id").cast("int").alias("id_int"), F.col("id").cast("string").alias("id_text"),
        F.col("termination_raw").try_cast("date").alias("left_on"),
        F.col("updated_at").cast("date").alias("updated_on"),
        F.col("valid_from").cast("string").alias("from_text"))


@query("scalars_date")
def dates(t):
    a, b = F.col("hire_date"), F.col("valid_from")
    return t.staff.select(
        "id", F.to_date(F.date_format(a, "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed"),
        F.date_add(a, 1).alias("next_day"), F.datediff(b, a).alias("days"),
        weeks_between(a, b, "sun").alias("sunday_weeks"),
        weeks_between(a, b, "mon").alias("monday_weeks"),
        month_diff(a, b).alias("months"), fractional_months(a, b).alias("rounded_months"),
        F.trunc(a, "month").alias("month_start"), F.dayofmonth(a).alias("day"),
        F.year(a).alias("year"), F.make_date(F.year(a) + 1, F.lit(1), F.lit(1)).alias("new_year"),
        F.date_format(b, "yyyy-MM-dd").alias("text"), F.lit(RUN_DAY).alias("run_day"))


@query("scalars_math")
def maths(t):
    balance = F.col("s_acctbal")
    return t.table("supplier").select(
        "s_suppkey", F.floor(balance).alias("floored"), F.round(balance / 7, 2).alias("rounded"),
        (F.col("s_suppkey") * 3 - 4).alias("linear"),
        (max_value(t.table("supplier"), "s_suppkey") + F.col("s_suppkey")).alias("after_max"))
