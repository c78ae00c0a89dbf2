"""Scalar Column functions (all JVM-side built-ins)."""

from visitlens.functions.buckets import in_bucket, step_bucket_counts, visit_bucket_counts
from visitlens.functions.dates import after, before, date_hour, format_time, minus, parse_time, seconds_between
from visitlens.functions.rounding import half_up_ratio
from visitlens.functions.text import (
    is_empty,
    is_not_empty,
    java_split,
    kv_between,
    kv_equal,
    kv_field,
    kv_in,
    kv_record,
    pad2,
    trim_comma,
)

__all__ = [
    "after",
    "before",
    "date_hour",
    "format_time",
    "half_up_ratio",
    "in_bucket",
    "is_empty",
    "is_not_empty",
    "java_split",
    "kv_between",
    "kv_equal",
    "kv_field",
    "kv_in",
    "kv_record",
    "minus",
    "pad2",
    "parse_time",
    "seconds_between",
    "step_bucket_counts",
    "trim_comma",
    "visit_bucket_counts",
]
