"""Bucket predicates for visit length (seconds) and step length (actions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.schema import STEP_BUCKETS, VISIT_BUCKETS


def in_bucket(x: Column, low: int, high: int | None) -> Column:
    """``low <= x <= high`` (``high`` None = open above)."""
    cond = x >= F.lit(low)
    return cond if high is None else cond & (x <= F.lit(high))


def in_bucket_sql(x: str, low: int, high: int | None) -> str:
    return f"{x} >= {low}" if high is None else f"{x} BETWEEN {low} AND {high}"


def weighted_count_sql(cond: str, weight: str | None = None) -> str:
    """SQL text: rows where ``cond`` holds, each counted ``weight`` times (bigint)."""
    if weight is None:
        return f"count_if({cond})"
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN {weight} END), 0) AS BIGINT)"


def _bucket_counts(column: str, buckets, prefix: str, weight: str | None) -> list[Column]:
    # one SQL text per aggregate: parsed in the JVM, not assembled call by call
    return [
        F.expr(weighted_count_sql(in_bucket_sql(f"`{column}`", lo, hi), weight)).alias(f"{prefix}{name}")
        for name, lo, hi in buckets
    ]


def visit_bucket_counts(column: str = "visit_length", prefix: str = "visit_length_",
                        weight: str | None = None) -> list[Column]:
    """One conditional count per visit-length bucket (NULL/0 s fall in none)."""
    return _bucket_counts(column, VISIT_BUCKETS, prefix, weight)


def step_bucket_counts(column: str = "step_length", prefix: str = "step_length_",
                       weight: str | None = None) -> list[Column]:
    return _bucket_counts(column, STEP_BUCKETS, prefix, weight)
