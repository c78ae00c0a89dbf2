"""DataFrame operators of the session analysis."""

from visitlens.operators.extract import (
    extract_sessions,
    hour_quotas,
    random_extract,
    sessions_per_day,
    sessions_per_hour,
)
from visitlens.operators.predicates import date_range, filter_sessions
from visitlens.operators.sessions import session_profile, session_rollup
from visitlens.operators.stats import (
    bucket_counts,
    session_aggr_stat,
    step_length_histogram,
    visit_length_histogram,
)
from visitlens.operators.topn import (
    category_actions,
    category_counts,
    kind_counts,
    session_category_clicks,
    session_detail,
    session_detail_inner,
    session_weights,
    top_categories,
    top_session_ids,
    top_sessions_per_category,
    user_weights,
)

__all__ = [
    "bucket_counts",
    "category_actions",
    "category_counts",
    "date_range",
    "extract_sessions",
    "filter_sessions",
    "hour_quotas",
    "kind_counts",
    "random_extract",
    "session_aggr_stat",
    "session_category_clicks",
    "session_detail",
    "session_detail_inner",
    "session_profile",
    "session_rollup",
    "session_weights",
    "sessions_per_day",
    "sessions_per_hour",
    "step_length_histogram",
    "top_categories",
    "top_session_ids",
    "top_sessions_per_category",
    "user_weights",
    "visit_length_histogram",
]
