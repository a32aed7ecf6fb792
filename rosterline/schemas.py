"""Input schemas and fixed column orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

OPEN_END = dt.date(2100, 12, 31)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_int, _long, _text = T.IntegerType(), T.LongType(), T.StringType()
_date, _time = T.DateType(), T.TimestampType()

# Staff dimension with history. dead = version closed, active = person employed.
STAFF_DIM = _schema(
    id=_long, person_name=_text, job_title=_text, has_reports=_int, area=_text,
    cost_center=_text, direct_report=_text, country=_text, gender=_text, hire_date=_date,
    active=_int, termination_date=_date, dead=_int, valid_from=_date, valid_to=_date,
    updated_at=_time, tenure_no=_int, owner_id=_long, crm_name=_text, crm_user_id=_long,
    education=_text, training=_text, country_2=_text, segment=_text, effective_boss=_text,
    birth_date=_date,
)

# Today's full staff list. has_reports is 'No' or anything else.
SNAPSHOT = _schema(
    person_no=_long, person_name=_text, job_title=_text, has_reports=_text, area=_text,
    cost_center=_text, direct_report=_text, country=_text, gender=_text, hire_date=_date,
    termination_date=_date, birth_date=_date,
)

LEAVERS = _schema(person_name=_text, termination_date=_date)
CALENDAR = _schema(dte=_date, yyyy=_int, mm=_int, ww=_int, week_start=_date)
COHORT = _schema(name=_text, start_date=_date, end_date=_date)
DISPOSITION = _schema(id=_text, label=_text)
COMPANY = _schema(company_id=_long, row_tag=_long)
CONTACT = _schema(
    contact_id=_long, company_id=_long, owner_id=_long, created_at=_time,
    last_contacted_at=_time, source_label=_text, lead_label=_text,
)
ACTIVITY = _schema(
    activity_id=_long, created_at=_time, owner_id=_long, activity_at=_time, activity_type=_text,
    status=_text, disposition_id=_text, call_duration=_int, meeting_outcome=_text,
    company_id=_long, contact_ids=_text,
)

# Attributes whose change opens a new version.
TRACKED = ("job_title", "has_reports", "area", "cost_center", "direct_report", "country",
           "gender", "termination_date")
# Attributes no feed delivers: taken over from a person's latest version.
CARRIED = ("education", "training", "country_2", "segment", "effective_boss", "birth_date")
CRM_IDS = ("crm_name", "owner_id", "crm_user_id")

# Column order of the dimension view.
VIEW_COLUMNS = (
    "id", "rank_id", "reverse_rank_id", "person_name", "job_title", "has_reports", "area",
    "cost_center", "direct_report", "country", "hire_date", "crm_name", "owner_id",
    "crm_user_id", "termination_date", "dead", "active", "valid_from",
    "valid_from_month_start", "valid_to", "subteam", "subteam_active", "job_class",
    "education", "birth_date", "age", "gender", "country_2", "segment", "class_start",
    "first_role_flag",
)
