"""SQL for the composite operators, built from named subqueries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from rosterline.schemas import CARRIED, STAFF_DIM, TRACKED, VIEW_COLUMNS

from .inputs import AS_OF, RUN_DAY

STAFF = STAFF_DIM.names
RUN = f"date '{RUN_DAY}'"
RUN_TIME = f"timestamp '{RUN_DAY} 00:00:00'"
OPEN = "date '2100-12-31'"
DEPTH = 7
FOLDED = {"area", "cost_center"}


def columns(changes: dict[str, str], table: str = "d", names: Iterable[str] = STAFF) -> str:
    return ", ".join(f"{changes[c]} as {c}" if c in changes else f"{table}.{c}" for c in names)


def name_key(col: str) -> str:
    return f"replace(trim({col}),'  ',' ')"


def compared(attribute: str, col: str) -> str:
    if attribute == "job_title":
        return name_key(col)
    return f"translate({col},'áéíóú','aeiou')" if attribute in FOLDED else col


def differs(a: str, b: str) -> str:
    return " or ".join(
        f"{compared(t, f'{a}.{t}')} <> {compared(t, f'{b}.{t}')}" for t in TRACKED)


# --- dimension with history ---------------------------------------------------------------

def insert(dim: str) -> str:
    fixed = {"id": f"(select max(id) from {dim}) + row_number() over (order by b.person_no)",
             "active": "1", "dead": "0", "valid_from": "b.hire_date", "valid_to": OPEN,
             "updated_at": RUN_TIME, "tenure_no": "1",
             **{c: f"cast(null as {k})" for c, k in (
                 ("owner_id", "bigint"), ("crm_name", "varchar"), ("crm_user_id", "bigint"),
                 ("education", "varchar"), ("training", "varchar"), ("country_2", "varchar"),
                 ("segment", "varchar"), ("effective_boss", "varchar"), ("birth_date", "date"))}}
    return f"""select {', '.join(STAFF)} from {dim} union all select {columns(fixed, 'b')} from snap b
 where not exists (select 1 from {dim} a where a.person_name = b.person_name)"""


def close(dim: str) -> str:
    hit = "d.dead = 0 and d.active = 1 and d.is_changed"
    return f"""select {columns({'dead': f'case when {hit} then 1 else d.dead end',
                               'valid_to': f'case when {hit} then {RUN} else d.valid_to end'})}
from (select d.*, exists(select 1 from snap b where b.person_name = d.person_name
       and ({differs('d', 'b')})) as is_changed from {dim} d) d"""


def version(dim: str) -> str:
    taken = {t: f"g.{t}" for t in TRACKED}
    fixed = {"id": f"(select max(id) from {dim}) + row_number() over (order by g.person_name)",
             "person_name": "g.person_name", **taken, "hire_date": "g.first_hire",
             "active": "1", "dead": "0", "valid_from": RUN, "valid_to": OPEN,
             "updated_at": RUN_TIME, "tenure_no": "g.last_tenure", "owner_id": "g.owner_id",
             "crm_name": "g.crm_name", "crm_user_id": "g.crm_user_id",
             **{c: f"l.{c}" for c in CARRIED}}
    return f"""select {', '.join(STAFF)} from {dim} union select {columns(fixed)}
from (select b.person_name, {', '.join('b.' + t for t in TRACKED)},
  min(a.first_hire) as first_hire, max(a.last_tenure) as last_tenure,
  max(a.owner_id) as owner_id, max(a.crm_name) as crm_name, max(a.crm_user_id) as crm_user_id
 from (select *, min(dead) over (partition by person_name) as all_dead,
        min(hire_date) over (partition by person_name) as first_hire,
        max(tenure_no) over (partition by person_name) as last_tenure from {dim}) a
 join snap b on a.person_name = b.person_name
 where a.all_dead = 1 and ({differs('a', 'b')})
 group by b.person_name, {', '.join('b.' + t for t in TRACKED)}) g
join (select *, row_number() over (partition by person_name
       order by updated_at desc nulls last, id desc) as place from {dim}) l
 on l.person_name = g.person_name and l.place = 1"""


def version_or_rehire(dim: str) -> str:
    """As :func:`version`; persons none of whose versions is active get the next tenure."""
    back = "g.max_active = 0"
    fixed = {"id": f"(select max(id) from {dim}) + row_number() over (order by g.person_name)",
             "person_name": "g.person_name", **{t: f"g.{t}" for t in TRACKED},
             "hire_date": f"case when {back} then g.new_hire else g.first_hire end",
             "active": "1", "dead": "0", "valid_from": RUN, "valid_to": OPEN,
             "updated_at": RUN_TIME,
             "tenure_no": f"cast(g.last_tenure + case when {back} then 1 else 0 end as int)",
             "owner_id": "g.owner_id", "crm_name": "g.crm_name", "crm_user_id": "g.crm_user_id",
             **{c: f"l.{c}" for c in CARRIED}}
    return f"""select {', '.join(STAFF)} from {dim} union all select {columns(fixed)}
from (select b.person_name, {', '.join('b.' + t for t in TRACKED)}, min(a.dead) as min_dead,
  max(a.active) as max_active, bool_or(coalesce({differs('a', 'b')}, false)) as any_changed,
  min(a.hire_date) as first_hire, max(b.hire_date) as new_hire, max(a.tenure_no) as last_tenure,
  max(a.owner_id) as owner_id, max(a.crm_name) as crm_name, max(a.crm_user_id) as crm_user_id
 from {dim} a join snap b on a.person_name = b.person_name
 group by b.person_name, {', '.join('b.' + t for t in TRACKED)}) g
join (select *, row_number() over (partition by person_name
       order by updated_at desc nulls last, id desc) as place from {dim}) l
 on l.person_name = g.person_name and l.place = 1
where (g.min_dead = 1 and g.any_changed) or {back}"""


def delete(dim: str, exempt: str) -> str:
    hit = (f"d.active = 1 and d.dead = 0 and not d.listed and d.person_name not like '{exempt}'")
    return f"""select {columns({
        'valid_to': f'case when {hit} then {RUN} else d.valid_to end',
        'active': f'case when {hit} then 0 else d.active end',
        'updated_at': f'case when {hit} then {RUN_TIME} else d.updated_at end'})}
from (select d.*, exists(select 1 from snap b where b.person_name = d.person_name) as listed
      from {dim} d) d"""


def fill_termination(dim: str) -> str:
    return f"""select {columns({'termination_date':
        'case when d.active = 0 then coalesce(d.termination_date, l.left_on) '
        'else d.termination_date end'})}
from {dim} d left join (select {name_key('person_name')} as nm, max(termination_date) as left_on
 from leavers group by 1) l on l.nm = d.person_name"""


def spread(dim: str) -> str:
    return f"""select {columns({'active': 'coalesce(g.low, d.active)',
                              'termination_date': 'coalesce(g.high, d.termination_date)'})}
from {dim} d left join (select person_name, tenure_no, min(active) as low,
  max(termination_date) as high from {dim} where termination_date is not null group by all) g
 on g.person_name = d.person_name and g.tenure_no = d.tenure_no"""


def clamp(dim: str) -> str:
    return f"""select {columns({'valid_to':
        'case when termination_date is null or termination_date > valid_to then valid_to '
        'else termination_date end'})} from {dim} d"""


def effective(dim: str) -> str:
    boss = name_key("d.direct_report")

    def touches(p: str) -> str:
        return (f"(d.valid_from between {p}.valid_from and {p}.valid_to "
                f"or d.valid_to between {p}.valid_from and {p}.valid_to)")

    return f"""select {columns({'effective_boss': '''case
  when d.is_open then d.direct_report when d.is_current then d.current_name
  when d.is_former then d.direct_report else 'Inactive' end'''})}
from (select d.*,
  exists(select 1 from {dim} p where {name_key('p.person_name')} = {boss} and p.dead = 0
    and p.active = 1 and {touches('p')}) as is_open,
  c.person_name is not null and c.valid_from between d.valid_from and d.valid_to as is_current,
  c.person_name as current_name,
  exists(select 1 from (select person_name, min(valid_from) as valid_from,
     max(valid_to) as valid_to from {dim} where active = 0 group by person_name, tenure_no) p
    where {name_key('p.person_name')} = {boss} and {touches('p')}) as is_former
 from {dim} d left join (select person_name, max(valid_from) as valid_from from {dim}
   where dead = 0 and active = 1 group by person_name) c
  on {name_key('c.person_name')} = {boss}) d"""


def defaults(dim: str, boss: str) -> str:
    return f"""select {columns({
        'country_2': "coalesce(o.country_2, d.country_2, d.country)",
        'segment': f"case when d.segment is not null then d.segment "
                   f"when d.direct_report = '{boss}' then 'SMB' "
                   f"when d.direct_report <> '{boss}' then 'Mid Market' end"})}
from {dim} d left join overrides o on o.id = d.id"""


OVERRIDES = "select id, 'N99' as country_2 from staff where country = 'N7'"


def add_birth(dim: str) -> str:
    return f"""select {columns({'birth_date': 'coalesce(d.birth_date, b.born)'})}
from {dim} d left join (select person_name, max(birth_date) as born from snap
 group by person_name) b on b.person_name = d.person_name"""


# --- dimension view -----------------------------------------------------------------------


def role_class(title: str = "job_title", area: str = "area", valid_to: str = "valid_to") -> str:
    """The role rules written out as SQL, apart from the library's rule table."""
    t, a = f"lower({title})", f"lower({area})"
    sales, customer = f"{a} like '%sales%'", f"{a} like '%customer%'"
    leader = f"({t} like '%leader%' or {t} like '%head%')"
    accounts = f"({t} like '%kam%' or {t} like '%account%' or {t} like '%key%')"
    return f"""case
 when {t} like '%chief revenue officer%' and {sales} then 'CSO'
 when {t} like '%vp sales%' and {sales} then 'Sales VP'
 when {t} like '%sales%manager%' and {sales} then 'Sales Manager'
 when {t} like '%expansions%' and {t} like '%head%' then 'Expansions Head'
 when {t} like '%expansions%' then 'Expansions Expert'
 when {t} like '%senior%' and {leader} and {t} not like '%sdr%' and {sales} then 'Sr Industry Head'
 when {leader} and {t} not like '%sdr%' and {sales} then 'Industry Head'
 when {t} like '%representative%' and ({sales} or {a} like '%sdr%')
  and {valid_to} >= date '2021-03-01' then 'Sales Developer Representative'
 when {t} like '%representative%' and {t} like '%lead%' and ({sales} or {a} like '%sdr%')
  then 'Sales Developer Representative Lead'
 when {t} like '%representative%' and {a} like '%growth%' then 'Sales Developer Representative'
 when {t} like '%sdr%' and {t} like '%head%' then 'SDR Head'
 when {t} like '%senior%' and {sales} then 'Sr Business Developer'
 when {t} like '%junior%' and {sales} then 'Jr Business Developer'
 when {t} like '%intern%' and {sales} then 'Intern Comercial'
 when {sales} then 'Business Developer'
 when {t} like '%vp%' and {customer} then 'Customer Success VP'
 when {t} = 'customer success senior manager' and {customer} then 'Customer Success Sr Manager'
 when {t} = 'student success manager' and {customer} then 'Student Success Manager'
 when {t} = 'customer experience manager' and {customer} then 'Customer Experience Manager'
 when {t} in ('customer success manager', 'customer sucess manager') and {customer}
  then 'Customer Success Manager'
 when {t} like '%head%' and ({t} like '%kam%' or {t} like '%account%') and {customer}
  then 'KAMs Head'
 when {t} like '%head%' and {t} like '%expansion%' and {customer} then 'Expansions Head'
 when {t} like '%head%' and {customer} then 'Customer Success Head'
 when ({t} like '%sr%' or {t} like '%senior%') and {accounts} and {customer} then 'Sr KAM'
 when {accounts} and {customer} then 'KAM'
 else 'Other' end"""


def leader(title: str = "job_title") -> str:
    t = f"lower({title})"
    return (f"({t} like '%leader%' or {t} like '%head%' "
            f"or ({t} like '%manager%' and {t} not like '%key%'))")


def age(birth: str, day: dt.date) -> str:
    return (f"cast({day.year} - year({birth}) - case when month({birth})*100 + day({birth}) > "
            f"{day.month * 100 + day.day} then 1 else 0 end as int)")


def staff_view(dim: str) -> str:
    names = [c for c in VIEW_COLUMNS if c not in ("class_start", "first_role_flag")]
    shown = {
        "rank_id": "cast(rank_id as int)", "reverse_rank_id": "cast(reverse_rank_id as int)",
        "active": "tenure_active",
        "valid_from": "case when rank_id = 1 then valid_from else valid_from + 1 end",
        "valid_from_month_start": "case when rank_id = 1 then "
            "cast(date_trunc('month', valid_from) as date) else valid_from + 1 end",
        "subteam": f"case when {leader()} then person_name else direct_report end",
        "subteam_active": f"case when {leader()} then case when tenure_active = 0 "
            "then 'Inactive' else person_name end else effective_boss end",
        "job_class": role_class(), "age": age("birth_date", AS_OF),
    }
    return f"""select {', '.join(names)},
 min(valid_from) over (partition by person_name, job_class) as class_start,
 case when min(valid_from) over (partition by person_name, job_class) = hire_date
  then 1 else 0 end as first_role_flag
from (select {columns(shown, 'd', names)} from (
 select * replace ({name_key('person_name')} as person_name,
                   {name_key('direct_report')} as direct_report),
  row_number() over (partition by person_name order by valid_from, id) as rank_id,
  row_number() over (partition by person_name order by valid_from desc, id desc)
   as reverse_rank_id,
  min(active) over (partition by person_name, tenure_no) as tenure_active from {dim}) d)"""


# --- hierarchy ----------------------------------------------------------------------------

def is_manager(n: int) -> str:
    t, a = f"lower(p{n}.job_title)", f"lower(p{n}.area)"
    below = f"and lower(p{n - 1}.job_title) not like '%manager%'" if n > 1 else ""
    return (f"(({t} like '%manager%' or ({t} like '%vp sales%' {below}) or ({t} like '%head%' "
            f"and {a} not like '%sales%' and {a} not like '%growth%')) "
            f"and {t} not like '%key%')")


def manager_case(value: str, default: str) -> str:
    branches = " ".join(f"when {is_manager(n)} then {value.format(n=n)}"
                        for n in range(1, DEPTH + 1))
    return f"case {branches} else {default} end"


def chain_joins(table: str, dated: bool) -> str:
    return " ".join(
        f"left join {table} p{n} on {name_key(f'p{n - 1}.direct_report')} = "
        f"{name_key(f'p{n}.person_name')}" + (f" and p{n - 1}.dte = p{n}.dte" if dated else "")
        for n in range(2, DEPTH + 1))


def current_manager() -> str:
    levels = ", ".join(f"p{n}.person_name as level_{n}_name, p{n}.job_title as level_{n}_title"
                       for n in range(2, DEPTH + 1))
    person = ("case when p{n}.termination_date is null then p{n}.person_name "
              "else 'Inactive' end")
    # "as materialized": the chain reads the table seven times
    return f"""with newest as materialized (select * from staff_view where reverse_rank_id = 1)
select p1.person_name, p1.job_title, p1.direct_report, {levels},
 {manager_case('{n}', '0')} as manager_level, {manager_case(person, "'Other'")} as manager
from newest p1 {chain_joins('newest', False)}"""


def roster(calendar: str = "calendar") -> str:
    y = AS_OF.year
    end = (f"case when p1.valid_to >= date '{y + 1}-01-01' then date '{y + 2}-01-01' "
           "else p1.valid_to end")
    return f"""select p1.*, c.*, b.direct_report as last_report
from staff_view p1 left join {calendar} c on c.dte between p1.valid_from and {end}
left join staff_view b on b.person_name = p1.direct_report and b.reverse_rank_id = 1"""


def daily_manager(roster: str = "roster") -> str:
    levels = ", ".join(f"p{n}.person_name as level_{n}_name, p{n}.dte as level_{n}_dte, "
                       f"p{n}.job_class as level_{n}_class" for n in range(2, DEPTH + 1))
    default = "coalesce(b.manager, 'Inactive')"
    return f"""select p1.person_name, p1.dte, p1.area, p1.direct_report, p1.job_title, p1.job_class,
 p1.country_2, p1.segment, p1.active, b.job_title as direct_report_title, {levels},
 {manager_case('{n}', '0')} as manager_level,
 {manager_case('p{n}.person_name', default)} as manager,
 p1.hire_date, p1.class_start, p1.first_role_flag
from {roster} p1 {chain_joins(roster, True)}
left join current_manager b
 on {name_key('p1.direct_report')} = {name_key('b.person_name')}"""


# --- tenure and stamps --------------------------------------------------------------------

def week_start(day: str, first_day: str) -> str:
    moved = f"({day}) + 1" if first_day == "sun" else day
    return f"cast(date_trunc('week', {moved}) as date)"


def weeks(a: str, b: str, first_day: str) -> str:
    return f"cast(({week_start(b, first_day)} - {week_start(a, first_day)}) // 7 as int)"


def months(a: str, b: str) -> str:
    return f"cast((year({b}) - year({a})) * 12 + month({b}) - month({a}) as int)"


def rounded_months(a: str, b: str) -> str:
    both_last = f"({a} = last_day({a}) and {b} = last_day({b}))"
    return (f"cast(round({months(a, b)} + case when day({a}) = day({b}) or {both_last} then 0 "
            f"else (day({b}) - day({a})) / 31.0 end, 0) as int)")


def tenure(event: str, start: str, first_day: str = "mon", kind: str | None = None,
           prefix: str = "", actual: str | None = None, week_mode: str = "calendar",
           month_mode: str = "calendar") -> str:
    actual = f"{prefix}actual_" if actual is None else actual
    days = f"cast({event} - {start} as int) + 1"
    wk = days if week_mode == "days" else f"{weeks(start, event, first_day)} + 1"
    mo = rounded_months(start, event) if month_mode == "rounded" else months(start, event)
    mo = f"{mo} + case when day({start}) <= 15 then 1 else 0 end"
    soon = f"{kind} = 'MEETING' and {days} between 0 and 7" if kind else "false"
    return f"""{days} as {prefix}days_since_entry,
 case when {soon} then 2 when {wk} <= 12 then {wk} else 13 end as {prefix}weeks_since_entry,
 case when {mo} <= 7 then {mo} else 7 end as {prefix}months_since_entry,
 case when {soon} then 2 else {wk} end as {actual}weeks_since_entry,
 {mo} as {actual}months_since_entry"""


def stamp_joins(day: str, owner: str = "f.owner_id", p: str = "") -> str:
    return f"""left join calendar {p}c on {p}c.dte = {day}
left join staff_view {p}s on {p}s.owner_id = {owner}
 and {p}c.dte between {p}s.valid_from and {p}s.valid_to
left join cohorts {p}h on {p}s.hire_date between {p}h.start_date and {p}h.end_date"""


def stamp_columns(p: str = "") -> str:
    calendar = ", ".join(f"{p}c.{c} as {p}{c}" for c in ("yyyy", "mm", "ww", "week_start", "dte"))
    staff = ", ".join(f"{p}s.{c} as {p}{c}" for c in (
        "hire_date", "person_name", "subteam", "subteam_active", "country_2"))
    return f"""{calendar}, {staff}, {p}s.area as {p}team,
 coalesce({p}h.name, 'Unidentified') as {p}cohort,
 {tenure(f'{p}c.dte', f'{p}s.hire_date', kind='f.activity_type', prefix=p)}"""


FACT_COLUMNS = """f.activity_id, f.company_id, f.contact_ids, f.activity_type, f.activity_date,
 o.label as call_outcome, f.meeting_outcome, f.status, f.call_duration,
 cast(f.created_at as date) as created_date"""
FACT_FROM = "activities f left join dispositions o on o.id = f.disposition_id"

STAMP = f"""select {FACT_COLUMNS}, {stamp_columns()}
from {FACT_FROM} {stamp_joins('f.activity_date')}"""

# Two stamped tables side by side, joined on the id.
ANALYSIS = f"""with own as ({STAMP}), created as (select f.activity_id as creation_id,
 {stamp_columns('creation_')} from activities f
 {stamp_joins('cast(f.created_at as date)', p='creation_')})
select own.*, created.* exclude (creation_id)
from own left join created on created.creation_id = own.activity_id"""


def moved(created: str, hired: str) -> str:
    week = f"{weeks(hired, f'({created} - 1)', 'sun')} + 1"
    return (f"case when {week} in (1, 4) then {created} + 6 when {week} = 3 "
            f"then {created} + 13 else {created} - 1 end")


CONTACTS = f"""select f.contact_id, f.company_id,
 a.yyyy, a.mm, a.ww, a.week_start, a.dte, c.yyyy as original_yyyy, c.mm as original_mm,
 c.ww as original_ww, c.week_start as original_week_start, c.dte as original_dte, s.hire_date,
 {tenure('a.dte', 's.hire_date')},
 {tenure('c.dte', 's.hire_date', 'sun', prefix='original_', actual='actual_original_')},
 coalesce(h.name, 'Unidentified') as creation_cohort, s.person_name, s.area as team, s.subteam,
 s.subteam_active, s.country, m.manager, s.country_2, s.segment, f.source_label,
 case when f.last_contacted_at <= c.dte + 5 then 1 else 0 end as contacted_soon,
 1 as contact_created, case when k.row_tag is not null then 1 else 0 end as has_row_tag,
 f.lead_label
from contacts f left join companies k on k.company_id = f.company_id
{stamp_joins('cast(f.created_at as date)')}
left join calendar m1 on m1.dte = {moved('c.dte', 's.hire_date')}
left join calendar a on a.dte = m1.dte + 1
left join daily_manager m on m.person_name = s.person_name and m.dte = a.dte"""
