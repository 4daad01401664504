"""Generic operators: joins, top-1-per-key, as-of lookups, data-quality checks."""

from .asof import asof_both, asof_scan, time_splits  # noqa: F401
from .distinct import dense_ids, distinct_bitmaps, merged_counts  # noqa: F401
from .joins import full_outer_merge, left_join_spread_nulls  # noqa: F401
from .latest import earliest_by, first_in_group_rows, latest_by  # noqa: F401
from .quality import Check, accepted_values, not_null, run_checks, unique, unique_combination  # noqa: F401
