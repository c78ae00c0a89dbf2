"""Session statistics: bucket counts and the 15 bucket ratios of a task.

One global aggregate over the filtered profile replaces the reference's
side-effecting accumulator: exact under task retry and speculative
execution, 64-bit counters, and partially aggregated (each map task sends
one row of 16 counters to the single final task).  Profile rows carry a
``weight`` (identical user rows folded together), so counts are sums of
weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.buckets import step_bucket_counts, visit_bucket_counts, weighted_count_sql
from visitlens.functions.rounding import half_up_ratio_sql
from visitlens.schema import STEP_BUCKETS, VISIT_BUCKETS

VISIT_COUNT_COLUMNS = [f"visit_length_{n}" for n, _, _ in VISIT_BUCKETS]
STEP_COUNT_COLUMNS = [f"step_length_{n}" for n, _, _ in STEP_BUCKETS]


def _weight(profile: DataFrame) -> str | None:
    return "weight" if "weight" in profile.columns else None


def bucket_counts(profile: DataFrame) -> DataFrame:
    """One row: ``session_count`` and a count per visit/step bucket (bigint)."""
    w = _weight(profile)
    return profile.agg(
        F.expr(weighted_count_sql("TRUE", w)).alias("session_count"),
        *visit_bucket_counts("visit_length", weight=w),
        *step_bucket_counts("step_length", weight=w),
    )


def session_aggr_stat(profile: DataFrame, taskid: int | None = None) -> DataFrame:
    """One row: session_count and each bucket's share, rounded half-up to 2 places.

    With no qualifying session the ratios are NULL (``run_task`` raises).
    """
    counts = bucket_counts(profile)
    # one SQL text for the 15 ratios: parsed once in the JVM instead of being
    # assembled from hundreds of Column calls on the driver
    ratios = [
        f"{half_up_ratio_sql(c, 'session_count', 'spark')} AS {c}_ratio"
        for c in VISIT_COUNT_COLUMNS + STEP_COUNT_COLUMNS
    ]
    cols = [f"CAST({int(taskid)} AS BIGINT) AS taskid"] if taskid is not None else []
    return counts.selectExpr(*cols, "session_count", *ratios)


def _histogram(profile: DataFrame, column: str, buckets, prefix: str) -> DataFrame:
    w = _weight(profile)
    maker = visit_bucket_counts if prefix.startswith("visit") else step_bucket_counts
    counts = profile.agg(*maker(column, prefix, w))
    pairs = ", ".join(f"{i}, '{name}', `{prefix}{name}`" for i, (name, _, _) in enumerate(buckets, 1))
    return counts.selectExpr(f"stack({len(buckets)}, {pairs}) AS (bucket_no, bucket, session_count)").select(
        F.col("bucket_no").cast("int"), "bucket", F.col("session_count").cast("bigint")
    )


def visit_length_histogram(profile: DataFrame) -> DataFrame:
    """Sessions per visit-length bucket, one row per bucket (bucket_no 1..9)."""
    return _histogram(profile, "visit_length", VISIT_BUCKETS, "visit_length_")


def step_length_histogram(profile: DataFrame) -> DataFrame:
    """Sessions per step-length bucket, one row per bucket (bucket_no 1..6)."""
    return _histogram(profile, "step_length", STEP_BUCKETS, "step_length_")
