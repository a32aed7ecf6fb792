"""The tables of :mod:`checks.inputs` as SQL, each a named subquery."""

from __future__ import annotations

TITLE = """case {i} when 0 then 'Senior Sales Head' when 1 then 'Sales Manager'
  when 2 then 'Junior Sales Developer' when 3 then 'Key Account Manager'
  when 4 then 'Customer Success Head' when 5 then 'Sales Representative'
  when 6 then 'VP Sales' else 'SDR Intern' end"""
AREA = "case s_suppkey%3 when 0 then 'Sales' when 1 then 'Customer' else 'growth' end"
BOSS = "lpad(cast(s_suppkey//2 as varchar), 9, '0')"
ZERO = "date '1995-01-01'"

STAFF_COLUMNS = """id, person_name, job_title, has_reports, area, cost_center, direct_report,
 country, gender, hire_date, active, termination_date, dead, valid_from, valid_to, updated_at,
 tenure_no, owner_id, crm_name, crm_user_id, education, training, country_2, segment,
 effective_boss, birth_date"""

SQL: dict[str, str] = {}

SQL["dim"] = f"""
select s_suppkey*10+v as id, replace(s_name,'#',' ') as person_name,
 {TITLE.format(i='(s_suppkey+v)%8')} as job_title,
 cast(s_suppkey%2 as int) as has_reports, {AREA} as area,
 'CC ' || cast(s_suppkey%5 as varchar) as cost_center,
 case when s_suppkey<>0 then 'Supplier ' || {BOSS} end as direct_report,
 'N' || cast(s_nationkey as varchar) as country,
 case when s_suppkey%7<>0 then case s_suppkey%2 when 0 then 'F' else 'M' end end as gender,
 {ZERO} + hired as hire_date,
 case when s_suppkey%9=0 then 0 else 1 end as active,
 case when gone then case when s_suppkey%18=0 then 'NULL'
   else cast({ZERO} + (hired+v*400+200) as varchar) end end as termination_raw,
 case when gone and s_suppkey%18<>0 then {ZERO} + (hired+v*400+200) end as termination_date,
 case when last_one then 0 else 1 end as dead,
 {ZERO} + (hired+v*400) as valid_from,
 case when not last_one then {ZERO} + (hired+(v+1)*400)
  when s_suppkey%9=0 then {ZERO} + (hired+v*400+300) else date '2100-12-31' end as valid_to,
 case when s_suppkey%17<>4 then cast({ZERO} + (hired+v*400) as timestamp) end as updated_at,
 1 as tenure_no, s_suppkey as owner_id, 'crm ' || cast(s_suppkey as varchar) as crm_name,
 s_suppkey+1000 as crm_user_id, 'branch ' || cast(s_suppkey%6 as varchar) as education,
 cast(null as varchar) as training,
 case when s_suppkey%4<>0 then 'N' || cast(s_nationkey as varchar) end as country_2,
 case when s_suppkey%5=0 then 'SMB' end as segment,
 case when s_suppkey%7=3 then 'Inactive'
  when s_suppkey<>0 then 'Supplier ' || {BOSS} end as effective_boss,
 case when s_suppkey%8<>1 then date '1960-01-01' + cast(s_suppkey*211%12000 as int) end
  as birth_date
from (select *, cast(s_suppkey*37%600 as int) as hired, v >= s_suppkey%4 as last_one,
       v >= s_suppkey%4 and s_suppkey%9=0 as gone
      from supplier, (select cast(unnest(range(4)) as int) as v)
      where v <= s_suppkey%4)"""

SQL["staff"] = f"select {STAFF_COLUMNS} from dim"

SQL["tenured"] = f"""
select * exclude (ended) replace (case when id%10>=2 then 2 else 1 end as tenure_no,
 case when ended then 0 else active end as active,
 case when ended then {ZERO} + cast(id//10*37%600 + 800 as int) else termination_date end
  as termination_date)
from (select *, id//10%4>=2 and id%10<2 as ended from staff)"""

SQL["snapshot"] = f"""
select s_suppkey as person_no, case when s_suppkey%11=3 then 'Ex' else '  ' end
  || replace(s_name,'#','  ') || ' ' as person_name,
 case when s_suppkey%7=0 then {TITLE.format(i='((s_suppkey+s_suppkey%4)%8)')}
  when s_suppkey%5=0 then 'Sales Manager' else 'Key Account Manager' end as job_title,
 case when s_suppkey%2=0 then 'No' else 'Si' end as has_reports,
 case when s_suppkey%7=0 then {AREA} when s_suppkey%4=0 then 'Atención'
  when s_suppkey%3=0 then 'Sales' else 'Customer' end as area,
 case when s_suppkey%7<>0 and s_suppkey%10=3 then 'Operación'
  else 'CC ' || cast(s_suppkey%5 as varchar) end as cost_center,
 case when s_suppkey<>0 then ' Supplier  ' || {BOSS} end as direct_report,
 'N' || cast(s_nationkey as varchar) as country,
 case when s_suppkey%7=0 then 'M' when s_suppkey%2=0 then 'F' else 'M' end as gender,
 {ZERO} + cast(s_suppkey*37%600 as int) as hire_date,
 cast(null as date) as termination_date,
 date '1960-01-01' + cast(s_suppkey*211%12000 as int) as birth_date
from supplier"""

# The snapshot as the run uses it.
SQL["snap"] = """
select person_no, replace(trim(person_name),'  ',' ') as person_name, job_title,
 case when has_reports='No' then 0 else 1 end as has_reports,
 translate(area,'áéíóú','aeiou') as area, translate(cost_center,'áéíóú','aeiou') as cost_center,
 replace(trim(direct_report),'  ',' ') as direct_report, country, gender, hire_date,
 termination_date, birth_date
from snapshot"""

SQL["leavers"] = f"""
select replace(s_name,'#','  ') || ' ' as person_name,
 cast({ZERO} + cast(s_suppkey*37%600+1500 as int) as varchar) as termination_raw,
 {ZERO} + cast(s_suppkey*37%600+1500 as int) as termination_date
from supplier where s_suppkey%18=0"""

SQL["activities"] = """
select o_orderkey as activity_id,
 cast(cast(o_orderdate as date) - cast(o_orderkey%40 as int) as timestamp) as created_at,
 o_custkey % (select count(*) from supplier) as owner_id,
 cast(o_orderdate as timestamp) as activity_at,
 case substr(o_orderpriority,1,1) when '1' then 'CALL' when '2' then 'EMAIL'
  when '3' then 'MEETING' when '4' then 'NOTE' else 'TASK' end as activity_type,
 o_orderstatus as status,
 case when substr(o_orderpriority,1,1)='1' then o_orderstatus end as disposition_id,
 case when substr(o_orderpriority,1,1)='1' then cast(o_custkey%3600 as int) end as call_duration,
 case when substr(o_orderpriority,1,1)='3' then 'outcome ' || o_orderstatus end
  as meeting_outcome,
 o_custkey as company_id, 'c' || cast(o_custkey as varchar) as contact_ids,
 cast(o_orderdate as date) as activity_date
from orders"""

SQL["shifts"] = """
select o_orderkey as shift_id,
 o_custkey % (select greatest(count(*)//20, 2) from supplier) as owner_id,
 cast(o_orderdate as date) as valid_from,
 cast(o_orderdate as date) + cast(o_orderkey % 97 % 40 as int) as valid_to
from orders"""

SQL["dispositions"] = """
select distinct case o_orderstatus when 'P' then 'PART' else o_orderstatus end as id,
 'Result ' || o_orderstatus as label from orders"""

SQL["calendar"] = """
select dte, cast(year(dte) as int) as yyyy, cast(month(dte) as int) as mm,
 cast(weekofyear(dte) as int) as ww, cast(date_trunc('week',dte) as date) as week_start
from (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31',
      interval 1 day)) as date) as dte)"""

SQL["workdays"] = """
select * from calendar where dayofweek(dte) not in (0, 6)
 and dte not between date '1996-03-05' and date '1996-03-29'"""

SQL["cohorts"] = """
select 'C' || cast(year(start_date) as varchar) || 'Q' || cast(quarter(start_date) as varchar)
  as name, start_date, cast(start_date + interval 3 month as date) - 1 as end_date
from (select distinct case when date_trunc('quarter', hire_date) = date '1995-04-01'
  then date '2090-04-01' else cast(date_trunc('quarter', hire_date) as date) end as start_date
 from dim)"""

SQL["contacts"] = """
select o_orderkey as contact_id, o_custkey as company_id,
 o_custkey % (select count(*) from supplier) as owner_id,
 cast(o_orderdate as timestamp) as created_at, last_contacted_at,
 o_orderpriority as source_label, o_orderstatus as lead_label
from orders left join (select l_orderkey, cast(min(l_shipdate) as timestamp) as last_contacted_at
  from lineitem group by l_orderkey) on o_orderkey = l_orderkey"""

SQL["companies"] = """
select c_custkey as company_id, case when c_custkey%3=0 then c_custkey end as row_tag
from customer"""
