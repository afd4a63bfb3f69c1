"""DataFrame-level building blocks shared by the finished queries."""

from .filters import (between_filter, date_floor_filter, future_filter, normalised,
                      normalised_match, not_in_filter, rolling_days_filter,
                      status_in_filter, trailing_id_window)
from .joins import (cast_key_join, employee_day_spine, heavy_keys, latest_per_key,
                    month_roster_counts, month_roster_join, month_target_join, roster_filter,
                    split_left_join, targets_for)
from .setops import pad_to, union_all, union_distinct, union_null_padded
from .windows import partition_count, ranked

__all__ = [
    "between_filter", "date_floor_filter", "future_filter", "normalised", "normalised_match",
    "not_in_filter", "rolling_days_filter", "status_in_filter",
    "trailing_id_window", "cast_key_join", "employee_day_spine", "heavy_keys",
    "latest_per_key", "month_roster_counts", "month_roster_join", "month_target_join", "roster_filter",
    "split_left_join", "targets_for", "pad_to", "union_all", "union_distinct",
    "union_null_padded", "partition_count", "ranked",
]
