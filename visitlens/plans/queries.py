"""

Every query reads the whole ``events`` / ``customer`` / ``nation`` tables
(through the fixture views); a date range applies only where it is the feature
(``visit_scan``, the statistics, ``session_detail_in_range``, the task's
outputs).  All return lazy DataFrames: building one runs and keeps nothing.
Columns are aliased exactly as in ``visitlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import after, before, format_time, minus, parse_time
from visitlens.functions.text import kv_between, kv_equal, kv_in, kv_record
from visitlens.operators import daily, extract, lists, predicates, sessions, stats, topn
from visitlens.params import TaskParams
from visitlens.sources import fixtures

TASK_ID = 1

# Parameters the registered queries use (FIXTURES.md §3).
STAT_PARAMS = TaskParams(
    start_date="2024-01-05",
    end_date="2024-01-25",
    start_age="20",
    end_age="40",
    sex="male",
    cities="NATION_10,NATION_2",
)
RANGE = (STAT_PARAMS.start_date, STAT_PARAMS.end_date)
KEYWORDS = "kw1,kw3"
CATEGORY_IDS = "5,17,42"
PROFESSIONALS = "AUTOMOBILE,BUILDING"
EXTRACT_PER_DAY = 50
EXTRACT_SEED = "0"
TIME_DIVISOR = 40  # compresses the clock so every visit-length bucket is hit
KV_PARAM = "startAge=20|endAge=40|cities=NATION_10,NATION_2|sex=male"
LOOKUP_TASK_ID = 20240115
LARGE_N = 5000
LONG_KEYWORDS = ",".join(f"kw{7 * i + 1}" for i in range(100_000))
LONG_CATEGORY_IDS = ",".join(str(9 * i + 4) for i in range(100_000))
VALUE_CHUNK = 4  # values of a chunk, few enough that sessions have several
KV_NO_PARAM = "sex=male"  # neither ages nor cities are given

PROFILE_OUT = ["session_id", "user_id", "start_time", "visit_length", "step_length", "age", "professional", "city", "sex",
               "weight"]


def _visits(spark: SparkSession, sf_dir: str, dated: bool = False, **kw) -> DataFrame:
    start, end = RANGE if dated else (None, None)
    v = fixtures.visit_actions(spark, sf_dir, start_date=start, end_date=end, **kw)
    return predicates.date_range(v, start, end)


def _profile(spark: SparkSession, sf_dir: str, params: TaskParams | None = None, dated: bool = False, **kw) -> DataFrame:
    rolled = sessions.session_rollup(_visits(spark, sf_dir, dated, **kw), params)
    return sessions.session_profile(rolled, fixtures.user_info(spark, sf_dir))


def _profile_out(df: DataFrame) -> DataFrame:
    return df.select(*[format_time(c).alias(c) if c == "start_time" else F.col(c) for c in PROFILE_OUT])


def _filtered(params: TaskParams) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prof = _profile(spark, sf_dir, params)
        return _profile_out(predicates.filter_sessions(prof, params))

    return run


# --- sources -------------------------------------------------------------------

def visit_scan(spark, sf_dir):
    v = _visits(spark, sf_dir, dated=True)
    return v.select(
        "datestr", "session_id", "user_id", format_time("action_time").alias("action_time"),
        "search_keyword", "click_category_id", "order_category_ids", "pay_category_ids",
    )


def lenient_times(spark, sf_dir):
    """Times whose fields are out of range or followed by text, read leniently and compared."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = lambda part, m: (F.col(part).cast("int") + F.col("event_id") % m).cast("string")
    parts = {"y": F.year("ts"), "mo": F.month("ts"), "d": F.dayofmonth("ts"), "h": F.hour("ts"), "mi": F.minute("ts"), "s": F.second("ts")}
    t = events.select("event_id", format_time("ts").alias("plain"), *[c.alias(n) for n, c in parts.items()])
    rolled = F.concat(F.col("y").cast("string"), F.lit("-"), number("mo", 15), F.lit("-"), number("d", 40), F.lit(" "),
                      number("h", 30), F.lit(":"), number("mi", 70), F.lit(":"), number("s", 100), F.lit(" GMT+1"))
    t1 = F.when(F.col("event_id") % 17 == 0, F.lit("not a time")).otherwise(rolled)
    t = t.select("event_id", t1.alias("t1"), F.concat("plain", F.lit(".5Z")).alias("t2"))
    return t.select(
        "event_id",
        format_time(parse_time("t1", lenient=True)).alias("time_read"),
        before("t1", "t2", lenient=True).alias("is_before"),
        after("t1", "t2", lenient=True).alias("is_after"),
        minus("t1", "t2", lenient=True).alias("seconds"),
    )


def user_scan(spark, sf_dir):
    return fixtures.user_info(spark, sf_dir)


def task_params(spark, sf_dir):
    """S6: every task's JSON parameters decoded to one text column per key."""
    from visitlens.sources.tasks import decode_params

    return decode_params(fixtures.task_table(spark, sf_dir))


def task_lookup(spark, sf_dir):
    """S4: one task looked up by key, with its decoded parameters."""
    from visitlens.sources.tasks import decode_params, task_by_id

    task = task_by_id(fixtures.task_table(spark, sf_dir), LOOKUP_TASK_ID)
    return decode_params(task, "task_name", "task_type", "task_status")


# --- sessions ------------------------------------------------------------------

def session_rollup(spark, sf_dir):
    r = sessions.session_rollup(_visits(spark, sf_dir))
    return r.select("session_id", "user_id", format_time("start_time").alias("start_time"),
                    "visit_length", "step_length")


def session_value_lists(spark, sf_dir):
    return sessions.session_value_lists(_visits(spark, sf_dir))


def session_values(spark, sf_dir):
    return sessions.session_values(_visits(spark, sf_dir))


def session_value_chunks(spark, sf_dir):
    """Each session's values in arrival order, in chunks joined by the reference's separator."""
    chunks = lists.session_value_chunks(_visits(spark, sf_dir, grain="month"), VALUE_CHUNK)
    return chunks.select("session_id", "user_id", "kind", "chunk_no", F.concat_ws(lists.SEPARATOR, "values").alias("chunk_values"))


def session_profile_lists(spark, sf_dir):
    """P1: the profile with its four ordered lists."""
    visits = _visits(spark, sf_dir)
    profile = sessions.session_profile(sessions.session_rollup(visits), fixtures.user_info(spark, sf_dir))
    wide = lists.session_profile_lists(profile, visits)
    return wide.withColumn("start_time", format_time("start_time"))


def rollup_from_daily(spark, sf_dir):
    """Sessions of a month merged from one state per session and day."""
    states = daily.daily_sessions(_visits(spark, sf_dir, grain="month"))
    r = daily.rollup_from_daily(states)
    return r.select("session_id", "user_id", format_time("start_time").alias("start_time"), "visit_length", "step_length")


def session_profile(spark, sf_dir):
    return _profile_out(_profile(spark, sf_dir))


# --- key-value record predicates -------------------------------------------------

def _kv_records(spark, sf_dir):
    prof = _profile(spark, sf_dir)
    rec = kv_record(age=F.col("age"), professional=F.col("professional"), city=F.col("city"), sex=F.col("sex"))
    return prof.select("session_id", "user_id", rec.alias("info"), "weight")


def kv_between_q(spark, sf_dir):
    r = _kv_records(spark, sf_dir)
    return r.where(kv_between("info", "age", F.lit(KV_PARAM), "startAge", "endAge"))


def kv_between_no_param(spark, sf_dir):
    """An absent parameter lets every record pass."""
    return _kv_records(spark, sf_dir).where(kv_between("info", "age", F.lit(KV_NO_PARAM), "startAge", "endAge"))


def kv_in_no_field(spark, sf_dir):
    """A record without the field does not pass."""
    r = _kv_records(spark, sf_dir).withColumn("info", F.regexp_replace("info", "city=[^|]*[01][|]", ""))
    return r.where(kv_in("info", "city", F.lit(KV_PARAM), "cities"))


def kv_in_q(spark, sf_dir):
    r = _kv_records(spark, sf_dir)
    return r.where(kv_in("info", "city", F.lit(KV_PARAM), "cities"))


def kv_equal_q(spark, sf_dir):
    r = _kv_records(spark, sf_dir)
    return r.where(kv_equal("info", "sex", F.lit(KV_PARAM), "sex"))


# --- statistics --------------------------------------------------------------------

def session_aggr_stat(spark, sf_dir, params: TaskParams = STAT_PARAMS, dated: bool = True, **kw):
    prof = _profile(spark, sf_dir, params, dated, **kw)
    return stats.session_aggr_stat(predicates.filter_sessions(prof, params), TASK_ID)


def session_aggr_stat_substring(spark, sf_dir):
    return session_aggr_stat(spark, sf_dir, STAT_PARAMS.with_options(list_match="substring"))


def session_aggr_stat_all(spark, sf_dir):
    """Every session of the month, clock compressed so all visit buckets fill."""
    return session_aggr_stat(spark, sf_dir, TaskParams(), dated=False, time_divisor=TIME_DIVISOR)


def session_bucket_counts(spark, sf_dir):
    prof = _profile(spark, sf_dir, STAT_PARAMS, dated=True)
    return stats.bucket_counts(predicates.filter_sessions(prof, STAT_PARAMS))


def visit_length_histogram(spark, sf_dir):
    return stats.visit_length_histogram(_profile(spark, sf_dir, dated=False, time_divisor=TIME_DIVISOR))


def step_length_histogram(spark, sf_dir):
    return stats.step_length_histogram(_profile(spark, sf_dir, dated=False, grain="month"))


# --- top-N -------------------------------------------------------------------------

def _actions_and_weights(spark, sf_dir, params: TaskParams = TaskParams(), kind: str | None = None, id_lists: bool = False):
    visits = _visits(spark, sf_dir)
    if id_lists:
        visits = _with_id_lists(visits)
    acts = topn.category_actions(visits, params.split_ids, kind)
    if params.top_scope == "filtered":
        prof = predicates.filter_sessions(_profile(spark, sf_dir, params, dated=False), params)
        weights = topn.session_weights(prof)
    else:
        weights = topn.user_weights(fixtures.user_info(spark, sf_dir))
    return acts, weights


def _with_id_lists(visits: DataFrame) -> DataFrame:
    """Orders and payments of two categories: the event's own and its product's number."""
    pair = lambda ids, more: F.concat_ws(",", F.col(ids), F.when(F.col(ids).isNotNull(), F.col(more)))
    return visits.withColumns({
        ids: F.when(F.col(ids).isNotNull(), pair(ids, more))
        for ids, more in (("order_category_ids", "order_product_ids"), ("pay_category_ids", "pay_product_ids"))
    })


def _kind_counts(kind: str, params: TaskParams = TaskParams(), id_lists: bool = False):
    def run(spark, sf_dir):
        acts, w = _actions_and_weights(spark, sf_dir, params, kind, id_lists)
        return topn.kind_counts(acts, w, kind)

    return run


def session_category_clicks(spark, sf_dir):
    acts, w = _actions_and_weights(spark, sf_dir, kind="click")
    return topn.session_category_clicks(acts, w)


def top10_category(spark, sf_dir, params: TaskParams = TaskParams()):
    acts, w = _actions_and_weights(spark, sf_dir, params)
    return topn.top_categories(topn.category_counts(acts, w), params.top_n, TASK_ID)


def top10_category_filtered(spark, sf_dir):
    p = TaskParams(start_age="20", end_age="40", sex="male", top_scope="filtered")
    return top10_category(spark, sf_dir, p)


def _top_sessions(spark, sf_dir, n: int = 10):
    acts, w = _actions_and_weights(spark, sf_dir, kind="click")
    return topn.top_sessions_per_category(topn.session_category_clicks(acts, w), n, TASK_ID)


def top_sessions_large(spark, sf_dir):
    """More rows per category than a partial window limit covers."""
    return _top_sessions(spark, sf_dir, LARGE_N)


def top10_session(spark, sf_dir):
    return _top_sessions(spark, sf_dir)


def top_session_ids(spark, sf_dir):
    return topn.top_session_ids(_top_sessions(spark, sf_dir))


def session_detail(spark, sf_dir):
    visits = fixtures.visit_actions(spark, sf_dir)
    return topn.session_detail(visits, _top_sessions(spark, sf_dir), TASK_ID, measure=False)


def session_detail_inner(spark, sf_dir):
    visits = fixtures.visit_actions(spark, sf_dir)
    return topn.session_detail_inner(visits, _top_sessions(spark, sf_dir), TASK_ID, measure=False)


def session_detail_in_range(spark, sf_dir):
    """D7 option: top sessions of the date range, actions exported only inside it."""
    params = TaskParams(start_date=RANGE[0], end_date=RANGE[1], restrict_dates=True)
    dated = _visits(spark, sf_dir, dated=True)
    acts = topn.category_actions(dated, params.split_ids, "click")
    w = topn.user_weights(fixtures.user_info(spark, sf_dir))
    top = topn.top_sessions_per_category(topn.session_category_clicks(acts, w), params.top_n, TASK_ID)
    return topn.session_detail(dated, top, TASK_ID, measure=False)


# --- extraction ---------------------------------------------------------------------

def sessions_per_hour(spark, sf_dir):
    return extract.sessions_per_hour(_profile(spark, sf_dir, dated=False))


def sessions_per_day(spark, sf_dir):
    return extract.sessions_per_day(_profile(spark, sf_dir, dated=False))


def extract_quotas(spark, sf_dir):
    return extract.hour_quotas(_profile(spark, sf_dir, dated=False), EXTRACT_PER_DAY)


def random_extract(spark, sf_dir, per_day: int = EXTRACT_PER_DAY):
    visits = _visits(spark, sf_dir)
    prof = sessions.session_profile(sessions.session_rollup(visits), fixtures.user_info(spark, sf_dir))
    return extract.random_extract(prof, visits, per_day, EXTRACT_SEED, TASK_ID, measure=False)


def random_extract_large(spark, sf_dir):
    """A draw larger than a partial window limit covers."""
    return random_extract(spark, sf_dir, LARGE_N)


# --- the task job's own outputs (run_task's code path: one shared aggregate) ---------

TASK_PARAMS = STAT_PARAMS.with_options(extract_per_day=EXTRACT_PER_DAY, extract_seed=EXTRACT_SEED)


def _task_table(name: str, from_states: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from visitlens.plans.job import build_task

        visits, users = fixtures.visit_actions(spark, sf_dir), fixtures.user_info(spark, sf_dir)
        states = daily.daily_states(visits) if from_states else None
        results, _ = build_task(visits, users, TASK_PARAMS, TASK_ID, reuse=False, states=states)
        return getattr(results, name)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "visit_scan": visit_scan,
    "user_scan": user_scan,
    "lenient_times": lenient_times,
    "task_params": task_params,
    "task_lookup": task_lookup,
    "session_rollup": session_rollup,
    "session_profile": session_profile,
    "session_value_lists": session_value_lists,
    "session_values": session_values,
    "session_value_chunks": session_value_chunks,
    "session_profile_lists": session_profile_lists,
    "rollup_from_daily": rollup_from_daily,
    "filter_age": _filtered(TaskParams(start_age="20", end_age="40")),
    "filter_age_open": _filtered(TaskParams(start_age="50")),
    "filter_professional": _filtered(TaskParams(professionals=PROFESSIONALS)),
    "filter_city": _filtered(TaskParams(cities=STAT_PARAMS.cities)),
    "filter_city_substring": _filtered(TaskParams(cities=STAT_PARAMS.cities, list_match="substring")),
    "filter_sex": _filtered(TaskParams(sex="male")),
    "filter_keywords": _filtered(TaskParams(keywords=KEYWORDS)),
    "filter_categories": _filtered(TaskParams(category_ids=CATEGORY_IDS)),
    "filter_keywords_substring": _filtered(TaskParams(keywords="w1", keyword_mode="substring")),
    "filter_categories_substring": _filtered(TaskParams(category_ids="7", category_mode="substring")),
    "filter_all": _filtered(
        TaskParams(start_age="20", end_age="60", professionals=PROFESSIONALS, sex="female",
                   keywords=KEYWORDS, category_ids=CATEGORY_IDS)
    ),
    "filter_keywords_long": _filtered(TaskParams(keywords=LONG_KEYWORDS)),
    "filter_categories_long": _filtered(TaskParams(category_ids=LONG_CATEGORY_IDS)),
    "filter_keywords_ignore": _filtered(TaskParams(keywords=KEYWORDS, keyword_mode="ignore")),
    "filter_categories_ignore": _filtered(TaskParams(category_ids=CATEGORY_IDS, category_mode="ignore")),
    "filter_professional_substring": _filtered(TaskParams(professionals=PROFESSIONALS, list_match="substring")),
    "kv_between": kv_between_q,
    "kv_between_no_param": kv_between_no_param,
    "kv_in_no_field": kv_in_no_field,
    "kv_in": kv_in_q,
    "kv_equal": kv_equal_q,
    "category_click_counts": _kind_counts("click"),
    "category_order_counts": _kind_counts("order"),
    "category_pay_counts": _kind_counts("pay"),
    "category_order_counts_split": _kind_counts("order", TaskParams(split_ids=True), id_lists=True),
    "category_order_counts_lists": _kind_counts("order", id_lists=True),
    "category_pay_counts_lists": _kind_counts("pay", id_lists=True),
    "session_category_clicks": session_category_clicks,
    "visit_length_histogram": visit_length_histogram,
    "step_length_histogram": step_length_histogram,
    "session_bucket_counts": session_bucket_counts,
    "session_aggr_stat": session_aggr_stat,
    "session_aggr_stat_substring": session_aggr_stat_substring,
    "session_aggr_stat_all": session_aggr_stat_all,
    "top10_category": top10_category,
    "top10_category_filtered": top10_category_filtered,
    "top10_session": top10_session,
    "top_sessions_large": top_sessions_large,
    "top_session_ids": top_session_ids,
    "session_detail": session_detail,
    "session_detail_inner": session_detail_inner,
    "session_detail_in_range": session_detail_in_range,
    "sessions_per_hour": sessions_per_hour,
    "sessions_per_day": sessions_per_day,
    "extract_quotas": extract_quotas,
    "random_extract": random_extract,
    "random_extract_large": random_extract_large,
    "task_session_aggr_stat": _task_table("session_aggr_stat"),
    "task_top10_category": _task_table("top10_category"),
    "task_top10_session": _task_table("top10_session"),
    "task_session_detail": _task_table("session_detail"),
    "task_random_extract": _task_table("session_random_extract"),
    "daily_session_aggr_stat": _task_table("session_aggr_stat", from_states=True),
    "daily_top10_category": _task_table("top10_category", from_states=True),
    "daily_top10_session": _task_table("top10_session", from_states=True),
    "daily_random_extract": _task_table("session_random_extract", from_states=True),
}
