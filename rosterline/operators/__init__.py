from .cover import cover, dense_keys, inside, pieces_with
from .dimview import dim_view, first_role, latest_version, ranked_versions, subteam, subteam_active
from .groups import (conflicting_owners, duplicate_keys, latest_rows, rank_in_group,
                     with_group_values)
from .hierarchy import (current_manager, daily_manager, daily_roster, manager_periods, open_days,
                        periods_to_days, walk_up)
from .ids import dense_ids, max_value
from .joins import (changed, ends_within, join_overlapping, join_range, join_valid_at, matched,
                    not_in, touching, update_from)
from .scd2 import (apply_defaults, backfill, clamp_valid_to, effective_manager, enrich,
                   prepare_snapshot, scd2_close_changed, scd2_new_entities, scd2_new_versions,
                   scd2_soft_delete, spread_by_group, spread_termination)
from .spread import HOT_ROWS, hot_keys, hot_keys_each, join_spread, ordinary
from .tenure import cap, tenure_metrics
from .timeline import (calendar_bounds, calendar_index, depth_changes, distinct_days,
                       duplicate_days, explode_days, overlap_periods, to_calendar,
                       uncovered_days)

__all__ = [
    "HOT_ROWS", "apply_defaults", "backfill", "calendar_bounds", "calendar_index", "cap",
    "changed", "clamp_valid_to", "conflicting_owners", "cover", "current_manager",
    "daily_manager", "daily_roster", "dense_ids", "dense_keys", "depth_changes", "dim_view",
    "distinct_days", "duplicate_days", "duplicate_keys", "effective_manager", "ends_within",
    "enrich", "explode_days", "first_role", "hot_keys", "hot_keys_each", "inside",
    "join_overlapping", "join_range", "join_spread", "join_valid_at", "latest_rows",
    "latest_version", "manager_periods", "matched", "max_value", "not_in", "open_days",
    "ordinary", "overlap_periods", "periods_to_days", "pieces_with", "prepare_snapshot",
    "rank_in_group", "ranked_versions", "scd2_close_changed", "scd2_new_entities",
    "scd2_new_versions", "scd2_soft_delete", "spread_by_group", "spread_termination", "subteam",
    "subteam_active", "tenure_metrics", "to_calendar", "touching", "uncovered_days",
    "update_from", "walk_up", "with_group_values",
]
