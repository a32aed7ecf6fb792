from .activity import (StampTables, TenureOptions, activity_analysis, on_calendar, staff_lookup,
                       stamp_activities, strip_prefix, unify_activities)
from .buckets import apply_snapshot, snapshot_digests, store_in_buckets
from .contacts import ContactTables, adjusted_date, contact_analysis, shifted_day
from .jobs import activity_job, contact_job, dimension_job, manager_job, view_job
from .refresh import changed_rows, cut_to_years, touched_years
from .scd2_run import RunOptions, load_dim, scd2_run

__all__ = [
    "ContactTables", "RunOptions", "StampTables", "TenureOptions", "activity_analysis",
    "activity_job", "adjusted_date", "apply_snapshot", "changed_rows", "contact_analysis",
    "contact_job", "cut_to_years", "dimension_job", "load_dim", "manager_job", "on_calendar",
    "scd2_run", "shifted_day", "snapshot_digests", "staff_lookup", "stamp_activities",
    "store_in_buckets", "strip_prefix", "touched_years", "unify_activities", "view_job",
]
