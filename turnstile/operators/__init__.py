from .aggregates import (
    date_range,
    duplicate_keys,
    filtered_totals,
    high_water_mark,
    labelled_counts,
    top_k,
    top_k_per,
    totals,
)
from .incremental import incremental_rows, reconcile
from .intervals import interval_join
from .joins import (
    effective_join,
    fits_broadcast,
    hot_for,
    hot_tokens,
    lookup_join,
    name_join,
)
from .latest import latest_by
from .orphans import orphan_count, orphan_rows, unrelated_pairs
from .overlaps import multiplied_rows, overlapping_periods
from .rejects import split_rejects
from .shape import (
    add_missing_columns,
    coerce_timestamps,
    conform,
    rename_columns,
    stamp,
    stamp_file,
)
from .upsert import MergeConflict, apply_upsert, merge_conflicts, merge_match, merge_state, upsert_by_hash

__all__ = [
    "MergeConflict", "add_missing_columns", "apply_upsert", "coerce_timestamps",
    "conform", "date_range", "duplicate_keys", "effective_join",
    "filtered_totals", "fits_broadcast", "high_water_mark", "hot_for",
    "hot_tokens", "incremental_rows", "interval_join",
    "labelled_counts", "latest_by", "lookup_join", "merge_conflicts",
    "merge_match", "merge_state",
    "multiplied_rows", "name_join", "orphan_count", "orphan_rows", "overlapping_periods", "reconcile", "rename_columns",
    "split_rejects", "stamp", "stamp_file", "top_k", "top_k_per", "totals", "unrelated_pairs",
    "upsert_by_hash",
]
