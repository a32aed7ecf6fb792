"""SQL counterparts of the registered queries."""

from __future__ import annotations

import re
from functools import cache

from . import sql_steps as q
from .inputs import AS_OF, ROLE_AREAS, ROLE_TITLES, RUN_DAY
from .queries import EXEMPT, SEGMENT_BOSS
from .sql_inputs import SQL

# Named subqueries in order of need.
NAMED: dict[str, str] = {
    **SQL,
    "overrides": q.OVERRIDES,
    "staff_view": q.staff_view("staff"),
    "current_manager": q.current_manager(),
    "roster": q.roster(),
    "daily_manager": q.daily_manager(),
    "work_roster": q.roster("workdays"),
    "work_manager": q.daily_manager("work_roster"),
    "closed": q.close("staff"),
    "some_snap": "select * from snap where person_no % 10 = 3",
    "some_closed": q.close("staff").replace("from snap b", "from some_snap b"),
    "run_1": q.insert("staff"),
    "run_2": q.close("run_1"),
    "run_3": q.version("run_2"),
    "run_4": q.delete("run_3", EXEMPT),
    "run_5": q.fill_termination("run_4"),
    "run_6": q.spread("run_5"),
    "run_7": q.clamp("run_6"),
    "run_8": q.effective("run_7"),
    "run_9": q.defaults("run_8", SEGMENT_BOSS),
    "back_1": q.insert("tenured"),
    "back_2": q.close("back_1"),
    "back_3": q.version_or_rehire("back_2"),
    "back_4": q.delete("back_3", EXEMPT),
    "back_5": q.fill_termination("back_4"),
    "back_6": q.spread("back_5"),
    "back_7": q.clamp("back_6"),
    "back_8": q.effective("back_7"),
    "back_9": q.defaults("back_8", SEGMENT_BOSS),
}


@cache
def _needs(text: str) -> frozenset[str]:
    names = {n for n in NAMED if re.search(rf"(from|join)\s+{n}\b|,\s*{n}\s+[a-z]\b", text)}
    return frozenset(names.union(*(_needs(NAMED[n]) for n in names)))


def complete(body: str) -> str:
    """The statement with the named subqueries it needs put before it."""
    needed = _needs(body)
    if not needed:
        return body
    named = ",\n".join(f"{n} as materialized ({NAMED[n]})" for n in NAMED if n in needed)
    return f"with {named}\nselect * from ({body})"


STAFF = ", ".join(q.STAFF)

BODIES: dict[str, str] = {
    "scd2_insert": "select * from run_1",
    "scd2_close": "select * from closed",
    "scd2_version": q.version("closed"),
    "scd2_changed_buckets": q.version("some_closed").replace("join snap b", "join some_snap b"),
    "scd2_delete": q.delete("staff", EXEMPT),
    "scd2_backfill": f"""select d.* replace (case when d.active = 0 and (d.termination_raw is null
  or d.termination_raw = 'NULL') then coalesce(l.left_on, d.termination_raw)
  else d.termination_raw end as termination_raw)
 from dim d left join (select {q.name_key('person_name')} as nm, max(termination_raw) as left_on
  from leavers group by 1) l on l.nm = d.person_name""",
    "scd2_spread": q.spread("staff"),
    "scd2_clamp": q.clamp("staff"),
    "effective_manager": q.effective("staff"),
    "default_cascade": q.defaults("staff", SEGMENT_BOSS),
    "enrich": q.add_birth("staff"),
    "scd2_run": q.add_birth("run_9"),
    "scd2_run_rehire": q.add_birth("back_9"),
    "scd2_spread_tenures": q.spread("tenured"),
    "effective_manager_tenures": q.effective("tenured"),
    "scd2_run_text": f"""select r.*, case when s.id is not null then 'note ' || s.id end as note
 from ({q.add_birth("run_9")}) r left join staff s on s.id = r.id""",
    "owner_conflicts": """select owner_id % 10 as owner_id, count(distinct person_name) as row_count
 from staff group by 1 having count(distinct person_name) > 1""",
    "default_cascade_repeated": q.defaults("staff", SEGMENT_BOSS),
    "catalog_roundtrip": """select o_orderstatus, count(*) as orders,
  cast(sum(o_custkey) as bigint) as customers
 from orders group by 1""",
    "land_quoted": """select c_custkey,
  c_name || ', "' || c_mktsegment || '"' || chr(10) || 'next line' as remark from customer""",
    "dim_view": "select * from staff_view",
    "classify_role": f"""select id, job_title, area, valid_to, {q.role_class()} as job_class
 from staff""",
    "classify_titles": f"""select *, {q.role_class()} as job_class from (
 select id, ({list(ROLE_TITLES)})[id % {len(ROLE_TITLES)} + 1] as job_title,
  ({list(ROLE_AREAS)})[id // 25 % {len(ROLE_AREAS)} + 1] as area, valid_to from staff)""",
    "subteam": f"""select id, case when {q.leader()} then person_name else direct_report end
  as subteam, case when {q.leader()} then case when active = 0 then 'Inactive'
  else person_name end else effective_boss end as subteam_active from staff""",
    "age": f"select id, birth_date, {q.age('birth_date', AS_OF)} as age from staff",
    "first_role": """select id, person_name, job_title, valid_from, hire_date,
 min(valid_from) over w as class_start,
 case when min(valid_from) over w = hire_date then 1 else 0 end as first_role_flag
 from staff window w as (partition by person_name, job_title)""",
    "latest_version": """select id, person_name, rank_id, valid_from, valid_to
 from staff_view where reverse_rank_id = 1""",
    "current_manager": "select * from current_manager",
    "daily_roster": "select * from roster",
    "daily_manager": "select * from daily_manager",
    "daily_roster_workdays": "select * from work_roster",
    "daily_manager_workdays": "select * from work_manager",
    "unify_activities": "select * from activities",
    "stamp_activities": q.STAMP,
    "activity_analysis": q.ANALYSIS,
    "tenure_metrics": f"""select f.activity_id, f.owner_id, f.activity_type, f.activity_date,
 s.hire_date, s.valid_from,
 {q.tenure('f.activity_date', 's.hire_date', kind='f.activity_type')},
 {q.tenure('f.activity_date', 's.hire_date', kind='f.activity_type', prefix='plain_',
           week_mode='days', month_mode='rounded')}
 from activities f left join staff s on s.owner_id = f.owner_id
  and f.activity_date between s.valid_from and s.valid_to""",
    "adjusted_date": f"""select f.contact_id, f.owner_id, cast(f.created_at as date) as created_date,
 s.hire_date, a.dte as adj_dte, a.yyyy as adj_yyyy, a.mm as adj_mm, a.ww as adj_ww,
 a.week_start as adj_week_start
 from contacts f
 left join (select owner_id, hire_date, row_number() over (partition by person_name
   order by valid_from desc, id desc) as place from staff) s
  on s.owner_id = f.owner_id and s.place = 1
 left join calendar m on m.dte = {q.moved('cast(f.created_at as date)', 's.hire_date')}
 left join calendar a on a.dte = m.dte + 1""",
    "contact_analysis": q.CONTACTS,
    "duplicate_keys": f"""select p.person_name, c.dte, count(*) as row_count
 from staff p left join calendar c on c.dte between p.valid_from and case
  when p.valid_to >= date '{AS_OF.year + 1}-01-01' then date '{AS_OF.year + 2}-01-01'
  else p.valid_to end group by all having count(*) > 1""",
    "duplicate_workdays": """select s.owner_id, c.dte, count(*) as row_count
 from shifts s left join workdays c on c.dte between s.valid_from and s.valid_to
 group by all having count(*) > 1""",
    "overlap_periods": """
 select owner_id, from_day, to_day, depth from (
  select owner_id, day as from_day, cast(lead(day) over w - 1 as date) as to_day,
   cast(sum(change) over (w rows between unbounded preceding and current row) as bigint) as depth
  from (select owner_id, day, sum(change) as change from (
    select owner_id, valid_from as day, 1 as change from shifts
    union all select owner_id, valid_to + 1, -1 from shifts) group by all)
  where change <> 0 window w as (partition by owner_id order by day))
 where depth >= 10""",
    "join_point_in_shifts": """select f.contact_id, f.owner_id % 2 as owner_id,
 cast(f.created_at as date) as created_date, s.shift_id, s.valid_from, s.valid_to
 from contacts f left join shifts s on s.owner_id = f.owner_id % 2
  and cast(f.created_at as date) between s.valid_from and s.valid_to
 where f.contact_id % 9 = 0""",
    **{name: f"""select a.owner_id, a.shift_id, a.valid_from, a.valid_to,
 b.shift_id as other_shift_id, b.valid_from as other_valid_from, b.valid_to as other_valid_to
 from (select * from shifts where shift_id % 5 = 0) a
 left join (select * from shifts where shift_id % 5 = 0) b
  on a.owner_id = b.owner_id and ({rule})"""
       for name, rule in (
           ("join_shifts_overlap", """a.valid_from between b.valid_from and b.valid_to
  or a.valid_to between b.valid_from and b.valid_to"""),
           ("join_shifts_full_overlap",
            "a.valid_from <= b.valid_to and b.valid_from <= a.valid_to"))},
    "effective_manager_by_pieces": q.effective("staff"),
    "daily_manager_refreshed": "select * from daily_manager",
    "activity_analysis_refreshed": q.ANALYSIS,
    "scan_parquet": """select o_orderkey, o_custkey, o_orderpriority from orders
 where o_totalprice > 250000""",
    "scan_fallback": "select c_custkey, c_name, c_nationkey from customer",
    "write_roundtrip": """select activity_id, owner_id, activity_date + 1 as activity_date,
 cast(year(activity_date) as int) as yyyy from activities""",
    "land_with_rejects": """select case when c_custkey % 13 <> 5 then c_custkey end as company_id,
 case when c_custkey % 7 <> 0 and c_custkey % 11 <> 4 then c_custkey * 2 end as row_tag,
 c_mktsegment as segment, concat_ws(', ',
  case when c_custkey % 13 = 5 then 'company_id=no ' || c_custkey end,
  case when c_custkey % 7 <> 0 and c_custkey % 11 = 4 then 'row_tag=?' end) as wrong
 from customer""",
    "stored_max": """select 'orders' as name, max(o_orderkey) as greatest from orders
 union all select 'customers', max(c_custkey) from customer""",
    "history_versions": """select id, person_name, case when country = 'N7' then 0 else active end
  as active, valid_to, active as active_before from staff""",
    "land_tables": """select s.*, l.termination_raw as left_on
 from snapshot s left join leavers l on l.person_name = s.person_name""",
    "clean_table": """select activity_id, lower(activity_type) as activity_type,
 coalesce(lower(disposition_id), '') as disposition_id,
 case when activity_id % 3 <> 0 then cast(activity_id as int) end as number_text
 from activities""",
    "surrogate_ids": """select c_custkey, c_mktsegment, (select max(c_custkey) from customer)
 + row_number() over (order by c_mktsegment, c_custkey) as new_id from customer""",
    "project": """select valid_from, date '2100-12-31' as valid_to, id, person_name as person,
 job_title as title, 0 as dead from staff""",
    "flags": """select f.contact_id,
 case when f.last_contacted_at <= cast(f.created_at as date) + 5 then 1 else 0 end
  as contacted_soon, case when k.row_tag is not null then 1 else 0 end as has_row_tag
 from contacts f left join companies k on k.company_id = f.company_id""",
    "null_default": """select id, coalesce(segment, 'none') as segment,
 coalesce(country_2, country) as country_2 from staff""",
    "predicates": """select id, cast(job_title ilike '%sales%manager%' as int) as is_sales_manager,
 cast(job_title not ilike '%key%' as int) as not_key, cast(gender <> 'F' as int) as other_gender,
 cast(valid_to is not null and dead = 1 as int) as ended,
 cast(valid_from between date '1997-01-01' and date '1997-12-31' as int) as in_1997,
 cast(job_title in ('VP Sales', 'SDR Intern') as int) as some_titles,
 cast(area not in ('Sales', 'growth') as int) as other_areas,
 cast(termination_raw is null or termination_raw = 'NULL' as int) as no_termination
 from dim where has_reports = 1 or segment is null""",
    "join_left": """select f.activity_id, f.disposition_id, f.activity_date, o.label, c.yyyy, c.mm,
 c.ww, c.week_start from activities f left join dispositions o on o.id = f.disposition_id
 left join calendar c on c.dte = f.activity_date""",
    "join_anti": """select person_no, person_name from snap
 where person_name not in (select person_name from staff)""",
    "join_inner": """select a.id, a.person_name, b.person_no from staff a
 join snap b on b.person_name = a.person_name""",
    "join_normalised": f"""select a.id, a.person_name, b.termination_raw from staff a
 join leavers b on {q.name_key('b.person_name')} = a.person_name""",
    "join_multikey": """select f.activity_id, f.owner_id, f.activity_date as dte, k.contacts,
 k.lead_label from activities f join (select owner_id, cast(created_at as date) as dte,
  count(*) as contacts, max(lead_label) as lead_label from contacts group by all) k
 on k.owner_id = f.owner_id and k.dte = f.activity_date""",
    "join_point_in_interval": """select f.activity_id, f.owner_id, f.activity_date, s.id,
 s.valid_from, s.valid_to from activities f left join staff s on s.owner_id = f.owner_id
 and f.activity_date between s.valid_from and s.valid_to""",
    "join_interval_overlap": f"""select a.id, {q.name_key('a.direct_report')} as boss, a.valid_from,
 a.valid_to, b.id as boss_id, b.valid_from as boss_from, b.valid_to as boss_to
 from staff a left join staff b on {q.name_key('a.direct_report')} = {q.name_key('b.person_name')}
  and (a.valid_from between b.valid_from and b.valid_to
       or a.valid_to between b.valid_from and b.valid_to)""",
    "join_range": """select f.activity_id, f.activity_date, h.name, h.start_date, h.end_date
 from activities f left join cohorts h on f.activity_date between h.start_date and h.end_date""",
    "join_agg": """select a.id, a.direct_report, b.versions, b.newest from staff a
 left join (select person_name, count(*) as versions, max(valid_from) as newest from staff
  where dead = 0 and active = 1 group by person_name) b on b.person_name = a.direct_report""",
    "latest_row": """select id, person_name, job_title, updated_at, 'one' as kind
 from (select *, row_number() over (partition by person_name
   order by updated_at desc nulls last, id desc) as place from staff) where place = 1
 union all select a.id, a.person_name, a.job_title, a.updated_at, 'tied'
 from staff a join (select job_title, max(updated_at) as top from staff group by job_title) b
  on b.job_title = a.job_title and b.top = a.updated_at""",
    "agg_basic": """select area, count(*) as versions, max(updated_at) as last_update,
 min(valid_from) as first_day, max(valid_to) as last_day, max(id) as top_id
 from staff group by area""",
    "agg_expr": """select area, has_reports as reports, job_title, max(person_name) as last_name,
 count(*) as people from snap group by all""",
    "distinct": "select distinct job_title, area, country from staff",
    "window_rank": """select id, person_name,
 cast(row_number() over (partition by person_name order by valid_from, id) as int) as rank_id,
 cast(row_number() over (partition by person_name order by valid_from desc, id desc) as int)
  as reverse_rank_id from staff""",
    "window_minmax": """select id, person_name, dead, hire_date, tenure_no,
 min(dead) over w as min_dead, min(hire_date) over w as first_hire,
 max(tenure_no) over w as last_tenure from staff window w as (partition by person_name)""",
    "sort": "select person_name, valid_from, id from staff order by person_name, valid_from",
    "limit": """select activity_id, activity_type from activities order by activity_id limit 5""",
    "union_all": """select person_name, job_title from staff
 union all select person_name, job_title from snap""",
    "union_distinct": """select person_name, area from staff
 union select person_name, area from snap""",
    "scalars_string": f"""select person_no, trim(person_name) as trimmed,
 {q.name_key('person_name')} as name_key, translate(area,'áéíóú','aeiou') as folded,
 lower(person_name) as low, upper(area) as high from snapshot""",
    "scalars_cast": """select id, cast(id as int) as id_int, cast(id as varchar) as id_text,
 try_cast(termination_raw as date) as left_on, cast(updated_at as date) as updated_on,
 cast(valid_from as varchar) as from_text from dim""",
    "scalars_date": f"""select id, hire_date as parsed, hire_date + 1 as next_day,
 cast(valid_from - hire_date as int) as days,
 {q.weeks('hire_date', 'valid_from', 'sun')} as sunday_weeks,
 {q.weeks('hire_date', 'valid_from', 'mon')} as monday_weeks,
 {q.months('hire_date', 'valid_from')} as months,
 {q.rounded_months('hire_date', 'valid_from')} as rounded_months,
 cast(date_trunc('month', hire_date) as date) as month_start, cast(day(hire_date) as int) as day,
 cast(year(hire_date) as int) as year, make_date(year(hire_date) + 1, 1, 1) as new_year,
 strftime(valid_from, '%Y-%m-%d') as text, date '{RUN_DAY}' as run_day from staff""",
    "scalars_math": """select s_suppkey, cast(floor(s_acctbal) as bigint) as floored,
 round(s_acctbal / 7, 2) as rounded, s_suppkey * 3 - 4 as linear,
 (select max(s_suppkey) from supplier) + s_suppkey as after_max from supplier""",
}

ORACLES = {name: complete(body) for name, body in BODIES.items()}
