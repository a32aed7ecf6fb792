"""Staff, CRM and calendar tables of the library's shape, derived from the given tables.

``SQL`` in :mod:`checks.sql_inputs` holds the same definitions as text.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(1999, 6, 30)       # for views and rosters
RUN_DAY = dt.date(2002, 1, 15)     # for dimension runs; after all versions begin
DAY_ZERO = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2001, 12, 31)
TITLES = ("Senior Sales Head", "Sales Manager", "Junior Sales Developer", "Key Account Manager",
          "Customer Success Head", "Sales Representative", "VP Sales")
# Titles that between them, over all areas, reach every rule that can be reached.
ROLE_TITLES = (
    "Chief Revenue Officer", "VP Sales", "Sales Country Manager", "Head of Expansions",
    "Expansions specialist", "Senior Team Leader", "Industry Head", "Representative",
    "Lead Representative", "Head of SDR", "Senior SDR Leader", "Junior Executive", "Intern",
    "Executive", "VP Success", "Customer Success Senior Manager", "Student Success Manager",
    "Customer Experience Manager", "Customer Sucess Manager", "Head of KAMs", "Expansion Head",
    "Head of Care", "Sr Key Account", "Account Manager", "Analyst")
ROLE_AREAS = ("Sales", "Customer", "growth", "SDR team")
TABLES = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
FEEDS = ("CALL", "EMAIL", "MEETING", "NOTE", "TASK")


def _pick(index: Column, values: tuple[str, ...], default: str) -> Column:
    picked = F.when(index == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        picked = picked.when(index == i, value)
    return picked.otherwise(default)


def _day(offset: Column, zero: dt.date = DAY_ZERO) -> Column:
    return F.date_add(F.lit(zero), offset.cast("int"))


class Inputs:
    """Derived tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in TABLES:  # saves a job that reads the footers
            reader = reader.schema(TABLES[name])
        return reader.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")

    @cached_property
    def dim(self) -> DataFrame:
        """Suppliers as staff, each with one to four versions that touch."""
        s, v = F.col("s_suppkey"), F.col("v")
        hired = s * 37 % 600
        last = v >= s % 4
        boss = F.concat(F.lit("Supplier "),
                        F.lpad(F.floor(s / 2).cast("string"), 9, "0"))
        left_on = _day(hired + v * 400 + 200)
        gone = last & (s % 9 == 0)
        return (
            self.table("supplier")
            .withColumn("v", F.explode(F.sequence(F.lit(0), (s % 4).cast("int"))))
            .select(
                (s * 10 + v).alias("id"),
                F.replace("s_name", F.lit("#"), F.lit(" ")).alias("person_name"),
                _pick((s + v) % 8, TITLES, "SDR Intern").alias("job_title"),
                (s % 2).cast("int").alias("has_reports"),
                _pick(s % 3, ("Sales", "Customer"), "growth").alias("area"),
                F.concat(F.lit("CC "), (s % 5).cast("string")).alias("cost_center"),
                F.when(s != 0, boss).alias("direct_report"),
                F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country"),
                F.when(s % 7 != 0, _pick(s % 2, ("F",), "M")).alias("gender"),
                _day(hired).alias("hire_date"),
                F.when(s % 9 == 0, 0).otherwise(1).alias("active"),
                F.when(gone, F.when(s % 18 == 0, "NULL").otherwise(left_on.cast("string")))
                .alias("termination_raw"),
                F.when(gone & (s % 18 != 0), left_on).alias("termination_date"),
                F.when(last, 0).otherwise(1).alias("dead"),
                _day(hired + v * 400).alias("valid_from"),
                F.when(~last, _day(hired + (v + 1) * 400))
                .when(s % 9 == 0, _day(hired + v * 400 + 300))
                .otherwise(F.lit(dt.date(2100, 12, 31))).alias("valid_to"),
                F.when(s % 17 != 4, _day(hired + v * 400).cast("timestamp"))
                .alias("updated_at"),
                F.lit(1).alias("tenure_no"),
                s.alias("owner_id"),
                F.concat(F.lit("crm "), s.cast("string")).alias("crm_name"),
                (s + 1000).alias("crm_user_id"),
                F.concat(F.lit("branch "), (s % 6).cast("string")).alias("education"),
                F.lit(None).cast("string").alias("training"),
                F.when(s % 4 != 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))
                .alias("country_2"),
                F.when(s % 5 == 0, "SMB").alias("segment"),
                F.when(s % 7 == 3, "Inactive").when(s != 0, boss).alias("effective_boss"),
                F.when(s % 8 != 1, _day(s * 211 % 12000, dt.date(1960, 1, 1)))
                .alias("birth_date"),
            )
        )

    @cached_property
    def staff(self) -> DataFrame:
        """The dimension without the raw termination text."""
        return self.dim.drop("termination_raw")

    @cached_property
    def tenured(self) -> DataFrame:
        """The dimension with persons who left after two versions and came back later."""
        s, v = F.floor(F.col("id") / 10), F.col("id") % 10
        ended = (s % 4 >= 2) & (v < 2)
        return self.staff.withColumns({
            "tenure_no": F.when(v >= 2, 2).otherwise(1),
            "active": F.when(ended, 0).otherwise(F.col("active")),
            "termination_date": F.when(ended, _day(s * 37 % 600 + 800))
            .otherwise(F.col("termination_date")),
        })

    @cached_property
    def snapshot(self) -> DataFrame:
        """A staff list of the day: untidy names, accents.

        Some people stand under another name: new people, while the old ones are missing.
        """
        s = F.col("s_suppkey")
        return self.table("supplier").select(
            s.alias("person_no"),
            F.concat(F.when(s % 11 == 3, "Ex").otherwise("  "),
                     F.replace("s_name", F.lit("#"), F.lit("  ")), F.lit(" "))
            .alias("person_name"),
            F.when(s % 7 == 0, _pick((s + s % 4) % 8, TITLES, "SDR Intern"))
            .when(s % 5 == 0, "Sales Manager").otherwise("Key Account Manager")
            .alias("job_title"),
            F.when(s % 2 == 0, "No").otherwise("Si").alias("has_reports"),
            F.when(s % 7 == 0, _pick(s % 3, ("Sales", "Customer"), "growth"))
            .when(s % 4 == 0, "Atención").when(s % 3 == 0, "Sales").otherwise("Customer")
            .alias("area"),
            F.when((s % 7 != 0) & (s % 10 == 3), "Operación")
            .otherwise(F.concat(F.lit("CC "), (s % 5).cast("string"))).alias("cost_center"),
            F.when(s != 0, F.concat(F.lit(" Supplier  "),
                                    F.lpad(F.floor(s / 2).cast("string"), 9, "0")))
            .alias("direct_report"),
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country"),
            F.when(s % 7 == 0, "M").otherwise(_pick(s % 2, ("F",), "M")).alias("gender"),
            _day(s * 37 % 600).alias("hire_date"),
            F.lit(None).cast("date").alias("termination_date"),
            _day(s * 211 % 12000, dt.date(1960, 1, 1)).alias("birth_date"),
        )

    @cached_property
    def leavers(self) -> DataFrame:
        s = F.col("s_suppkey")
        left_on = _day(s * 37 % 600 + 1500)
        return self.table("supplier").filter(s % 18 == 0).select(
            F.concat(F.replace("s_name", F.lit("#"), F.lit("  ")), F.lit(" "))
            .alias("person_name"),
            left_on.cast("string").alias("termination_raw"),
            left_on.alias("termination_date"),
        )

    def _owner(self, customer: str) -> Column:
        people = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        return F.col(customer) % people

    @cached_property
    def activities(self) -> DataFrame:
        """Orders as CRM activities of all five types, in one table."""
        rank = F.substring("o_orderpriority", 1, 1)
        return self.table("orders").select(
            F.col("o_orderkey").alias("activity_id"),
            F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 40).cast("int"))
            .cast("timestamp").alias("created_at"),
            self._owner("o_custkey").alias("owner_id"),
            F.col("o_orderdate").cast("timestamp").alias("activity_at"),
            _pick(rank.cast("int") - 1, FEEDS[:4], FEEDS[4]).alias("activity_type"),
            F.col("o_orderstatus").alias("status"),
            F.when(rank == "1", F.col("o_orderstatus")).alias("disposition_id"),
            F.when(rank == "1", (F.col("o_custkey") % 3600).cast("int")).alias("call_duration"),
            F.when(rank == "3", F.concat(F.lit("outcome "), "o_orderstatus"))
            .alias("meeting_outcome"),
            F.col("o_custkey").alias("company_id"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("contact_ids"),
        )

    @cached_property
    def feeds(self) -> list[DataFrame]:
        """The activities as five feeds: prefixed columns, each without some of them."""
        plain = ("activity_id", "created_at")
        lacks = {
            "CALL": {"meeting_outcome"}, "EMAIL": {"meeting_outcome", "call_duration",
                                                   "disposition_id"},
            "MEETING": {"call_duration", "disposition_id"},
            "NOTE": {"meeting_outcome", "call_duration", "disposition_id"},
            "TASK": {"meeting_outcome", "call_duration", "disposition_id"},
        }
        feeds = []
        for kind in FEEDS:
            part = self.activities.filter(F.col("activity_type") == kind)
            feeds.append(part.select(*[
                F.col(c).alias(c if c in plain else f"properties.{c}")
                for c in part.columns if c not in lacks[kind]]))
        return feeds

    @cached_property
    def shifts(self) -> DataFrame:
        """Orders as short shifts of few owners, each with very many that overlap."""
        first = F.col("o_orderdate").cast("date")
        owners = self.table("supplier").agg(F.greatest(
            F.floor(F.count(F.lit(1)) / 20), F.lit(2))).scalar()
        return self.table("orders").select(
            F.col("o_orderkey").alias("shift_id"), (F.col("o_custkey") % owners).alias("owner_id"),
            first.alias("valid_from"),
            F.date_add(first, (F.col("o_orderkey") % 97 % 40).cast("int")).alias("valid_to"))

    @cached_property
    def dispositions(self) -> DataFrame:
        """Call results: the order states, one under a name that no activity has."""
        named = F.when(F.col("o_orderstatus") == "P", "PART").otherwise(F.col("o_orderstatus"))
        return (self.table("orders").groupBy(named.alias("id"))
                .agg(F.concat(F.lit("Result "), F.min("o_orderstatus")).alias("label")))

    @cached_property
    def calendar(self) -> DataFrame:
        days = self.spark.range(1).select(
            F.explode(F.sequence(F.lit(DAY_ZERO), F.lit(LAST_DAY))).alias("dte"))
        return days.select(
            "dte", F.year("dte").alias("yyyy"), F.month("dte").alias("mm"),
            F.weekofyear("dte").alias("ww"), F.trunc("dte", "week").alias("week_start"))

    @cached_property
    def workdays(self) -> DataFrame:
        """A calendar without weekends, and without most of one month."""
        free = F.dayofweek("dte").isin(1, 7) | F.col("dte").between(
            F.lit(dt.date(1996, 3, 5)), F.lit(dt.date(1996, 3, 29)))
        return self.calendar.filter(~free)

    @cached_property
    def cohorts(self) -> DataFrame:
        """Quarters of hiring, one of them moved to where nobody was hired."""
        quarter = F.trunc("hire_date", "quarter")
        moved = F.when(quarter == F.lit(dt.date(1995, 4, 1)), F.lit(dt.date(2090, 4, 1)))
        return (
            self.dim.select(F.coalesce(moved, quarter).alias("start_date")).distinct()
            .select(
                F.concat(F.lit("C"), F.year("start_date").cast("string"), F.lit("Q"),
                         F.quarter("start_date").cast("string")).alias("name"),
                "start_date",
                F.date_sub(F.add_months("start_date", 3), 1).alias("end_date")))

    @cached_property
    def contacts(self) -> DataFrame:
        shipped = self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_shipdate").cast("timestamp").alias("last_contacted_at"))
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("contact_id"), F.col("o_custkey").alias("company_id"),
            self._owner("o_custkey").alias("owner_id"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.col("o_orderpriority").alias("source_label"),
            F.col("o_orderstatus").alias("lead_label"))
        return orders.join(shipped, F.col("contact_id") == F.col("l_orderkey"), "left").drop(
            "l_orderkey")

    @cached_property
    def companies(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.table("customer").select(
            c.alias("company_id"), F.when(c % 3 == 0, c).alias("row_tag"))
