"""Scalar value functions (V1-V9), all built-in column expressions."""

from .values import (
    apply_null_policy, as_float, as_timestamp, fill_defaults, json_text, key_of, null_policy_exprs,
    sanitize_name, sanitize_name_col, stringify, strip_control, typed,
)

__all__ = ["apply_null_policy", "as_float", "as_timestamp", "fill_defaults", "json_text", "key_of",
           "null_policy_exprs", "sanitize_name", "sanitize_name_col", "stringify",
           "strip_control", "typed"]
