"""Schemas of the inputs and result tables, and the fixed bucket names."""

from __future__ import annotations

from pyspark.sql import types as T

# --- inputs -----------------------------------------------------------------

# Visit log, one row per user action.  Exactly one action kind is normally set
# per row; the columns of the other kinds are NULL.  Ids of the order / pay
# kinds are comma-capable strings (plural names), click ids are numbers.
VISIT_ACTION = T.StructType(
    [
        T.StructField("datestr", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
    ]
)
VISIT_COLUMNS = [f.name for f in VISIT_ACTION.fields]

# The delimited-text form of the visit log: every field is text.
VISIT_ACTION_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in VISIT_ACTION.fields])

USER_INFO = T.StructType(
    [
        T.StructField("userid", T.LongType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

TASK = T.StructType(
    [
        T.StructField("taskid", T.LongType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("finish_time", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("task_status", T.StringType()),
        T.StructField("task_param", T.StringType()),
    ]
)

# --- fixed values that must equal the reference's ----------------------------
# JSON keys of a task's ``task_param`` object (every value is read as text).
TASK_PARAM_KEYS = ["startDate", "endDate", "startAge", "endAge", "professionals", "cities", "sex", "keywords",
                   "categoryIds"]
# Field separator and missing-value text of the delimited visit-log files.
VISIT_TEXT_SEPARATOR = "\u0001"
VISIT_TEXT_NULL = "null"
# Visit-length buckets in whole seconds, inclusive (name, low, high); None = open.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step-length buckets in actions, inclusive (name, low, high); None = open.
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]
# --- end of fixed values ------------------------------------------------------

TASK_PARAM = T.StructType([T.StructField(name, T.StringType()) for name in TASK_PARAM_KEYS])

VISIT_RATIO_COLUMNS = [f"visit_length_{name}_ratio" for name, _, _ in VISIT_BUCKETS]
STEP_RATIO_COLUMNS = [f"step_length_{name}_ratio" for name, _, _ in STEP_BUCKETS]

# --- result tables ----------------------------------------------------------

SESSION_AGGR_STAT = T.StructType(
    [T.StructField("taskid", T.LongType()), T.StructField("session_count", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in VISIT_RATIO_COLUMNS + STEP_RATIO_COLUMNS]
)

TOP10_CATEGORY = T.StructType(
    [
        T.StructField("taskid", T.LongType()),
        T.StructField("categoryid", T.LongType()),
        T.StructField("click_count", T.LongType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("pay_count", T.LongType()),
    ]
)

TOP10_SESSION = T.StructType(
    [
        T.StructField("taskid", T.LongType()),
        T.StructField("categoryid", T.LongType()),
        T.StructField("sessionid", T.StringType()),
        T.StructField("click_count", T.LongType()),
    ]
)

SESSION_DETAIL = T.StructType(
    [
        T.StructField("taskid", T.LongType()),
        T.StructField("userid", T.LongType()),
        T.StructField("sessionid", T.StringType()),
        T.StructField("pageid", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.StringType()),
        T.StructField("click_product_id", T.StringType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
    ]
)

SESSION_RANDOM_EXTRACT = T.StructType(
    [
        T.StructField("taskid", T.LongType()),
        T.StructField("sessionid", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("search_keywords", T.StringType()),
        T.StructField("click_category_ids", T.StringType()),
    ]
)

RESULT_TABLES = {
    "session_aggr_stat": SESSION_AGGR_STAT,
    "top10_category": TOP10_CATEGORY,
    "top10_session": TOP10_SESSION,
    "session_detail": SESSION_DETAIL,
    "session_random_extract": SESSION_RANDOM_EXTRACT,
}
