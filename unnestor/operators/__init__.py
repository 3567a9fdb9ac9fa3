"""Operators: unnesting (G1-G4), keyed upsert (K4, K6) and checks."""

from .checks import column_profile, reconcile, row_counts, schema_diff, schema_drift, schema_matches
from .unnest import extract_path_items, flatten_struct, unnest_records, unnest_values
from .upsert import latest_per_key, merge_upsert, split_bad_rows

__all__ = [
    "column_profile", "reconcile", "row_counts", "schema_diff", "schema_drift", "schema_matches",
    "extract_path_items", "flatten_struct", "unnest_records", "unnest_values",
    "latest_per_key", "merge_upsert", "split_bad_rows",
]
