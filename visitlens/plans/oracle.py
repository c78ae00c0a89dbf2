"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the DataFrame code: joins instead of weights,
EXISTS instead of per-session hit flags, window functions over whole
tables, bucket bounds and the rounding rule written out.  Only names of
tasks and the parameters a query runs with come from there.  Tables ``events``, ``customer`` and ``nation`` are views the caller
registers; the fixture views are rebuilt inline as CTEs.
"""

from __future__ import annotations

from visitlens.plans import queries as Q

# Bucket names and their conditions.
VISIT_BUCKETS = {
    "1s_3s": "visit_length IN (1, 2, 3)",
    "4s_6s": "visit_length IN (4, 5, 6)",
    "7s_9s": "visit_length IN (7, 8, 9)",
    "10s_30s": "visit_length >= 10 AND visit_length <= 30",
    "30s_60s": "visit_length > 30 AND visit_length <= 60",
    "1m_3m": "visit_length > 60 AND visit_length <= 3 * 60",
    "3m_10m": "visit_length > 3 * 60 AND visit_length <= 10 * 60",
    "10m_30m": "visit_length > 10 * 60 AND visit_length <= 30 * 60",
    "30m": "visit_length > 30 * 60",
}
STEP_BUCKETS = {
    "1_3": "step_length IN (1, 2, 3)",
    "4_6": "step_length IN (4, 5, 6)",
    "7_9": "step_length IN (7, 8, 9)",
    "10_30": "step_length >= 10 AND step_length <= 30",
    "30_60": "step_length > 30 AND step_length <= 60",
    "60": "step_length > 60",
}


def _ratio(n: str, d: str) -> str:
    """Half up to two decimals on the exact binary value of the double quotient: the quotient
    scaled by 2**60 is an integer, so ties and remainders are compared without rounding."""
    scaled = f"CAST(({n}::DOUBLE / nullif({d}, 0)::DOUBLE) * 1152921504606846976 AS HUGEINT)"
    return f"CAST(({scaled} * 200 + 1152921504606846976) // 2305843009213693952 AS DOUBLE) / 100.0"


START, END = Q.RANGE
TIME_FMT = "%Y-%m-%d %H:%M:%S"


def _uva(grain: str = "day", divisor: int = 1, dated: bool = False, start: str = START, end: str = END,
         name: str = "uva") -> str:
    dated = dated or (start, end) != (START, END)
    sess_fmt = {"day": "%Y-%m-%d", "month": "%Y-%m"}[grain]
    t = "ts" if divisor == 1 else (
        f"(date_trunc('day', ts) + to_seconds((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // {divisor}))"
    )
    where = f"WHERE strftime(ts, '%Y-%m-%d') BETWEEN '{start}' AND '{end}'" if dated else ""
    return f"""{name} AS (
  SELECT strftime(ts, '%Y-%m-%d') AS datestr, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '{sess_fmt}') AS session_id,
         event_id % 10 AS page_id, {t} AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  {where})"""


TASKS = """tasks AS (
  SELECT CAST(replace(day, '-', '') AS BIGINT) AS taskid, 'day ' || day AS task_name, 'session' AS task_type,
         'new' AS task_status,
         json_object('startDate', day, 'endDate', day, 'startAge', '20', 'endAge', '40',
                     'sex', CASE WHEN day(CAST(day AS DATE)) % 2 = 1 THEN 'female' ELSE 'male' END,
                     'categoryIds', CASE WHEN day(CAST(day AS DATE)) % 2 = 1 THEN json('[5,17]') END) AS task_param
  FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events))"""

DECODED = """taskid,
       json_extract_string(task_param, '$.startDate') AS start_date,
       json_extract_string(task_param, '$.endDate') AS end_date,
       json_extract_string(task_param, '$.startAge') AS start_age,
       json_extract_string(task_param, '$.endAge') AS end_age,
       json_extract_string(task_param, '$.professionals') AS professionals,
       json_extract_string(task_param, '$.cities') AS cities,
       json_extract_string(task_param, '$.sex') AS sex,
       json_extract_string(task_param, '$.keywords') AS keywords,
       json_extract_string(task_param, '$.categoryIds') AS category_ids"""

UI = """ui AS (
  SELECT c_custkey AS userid, CAST(18 + c_custkey % 43 AS INTEGER) AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SESS = """sess AS (
  SELECT session_id, user_id, min(action_time) AS start_time,
         date_diff('second', date_trunc('second', min(action_time)), date_trunc('second', max(action_time))) AS visit_length,
         count(session_id) AS step_length
  FROM uva GROUP BY session_id, user_id)"""

PROF = """prof AS (
  SELECT s.session_id, s.user_id, s.start_time, s.visit_length, s.step_length, u.age, u.professional, u.city, u.sex
  FROM sess s JOIN ui u ON s.user_id = u.userid)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _base(grain: str = "day", divisor: int = 1, dated: bool = False) -> list[str]:
    return [_uva(grain, divisor, dated), UI, SESS, PROF]


PROFILE_SELECT = (
    f"SELECT session_id, user_id, strftime(start_time, '{TIME_FMT}') AS start_time, visit_length, step_length, "
    "age, professional, city, sex, count(*) AS weight FROM prof p"
)


def _in_list(csv: str) -> str:
    return ", ".join(f"'{t.strip()}'" for t in csv.split(","))


def _exists_action(cond: str) -> str:
    return f"EXISTS (SELECT 1 FROM uva a WHERE a.session_id = p.session_id AND a.user_id = p.user_id AND {cond})"


KEYWORD_COND = _exists_action(f"a.search_keyword IN ({_in_list(Q.KEYWORDS)})")
CATEGORY_COND = _exists_action(f"a.click_category_id IN ({Q.CATEGORY_IDS})")


def _filtered(where: str) -> str:
    return _with(*_base()) + PROFILE_SELECT + " WHERE " + where + " GROUP BY ALL"


def _counts_cte(where: str = "TRUE", name: str = "cnt") -> str:
    cols = ["count(*) AS session_count"]
    cols += [f"count(*) FILTER ({c}) AS visit_length_{n}" for n, c in VISIT_BUCKETS.items()]
    cols += [f"count(*) FILTER ({c}) AS step_length_{n}" for n, c in STEP_BUCKETS.items()]
    return f"{name} AS (SELECT {', '.join(cols)} FROM prof p WHERE {where})"


def _stat(where: str, **base) -> str:
    names = [f"visit_length_{n}" for n in VISIT_BUCKETS] + [f"step_length_{n}" for n in STEP_BUCKETS]
    ratios = [f"{_ratio(n, 'session_count')} AS {n}_ratio" for n in names]
    return (_with(*_base(**{"dated": True, **base}), _counts_cte(where))
            + f"SELECT CAST({Q.TASK_ID} AS BIGINT) AS taskid, session_count, {', '.join(ratios)} FROM cnt")


def _histogram(buckets: dict, **base) -> str:
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS bucket_no, '{n}' AS bucket, count(*) FILTER ({c}) AS session_count FROM prof"
        for i, (n, c) in enumerate(buckets.items(), 1)
    ]
    return _with(*_base(**base)) + "\nUNION ALL\n".join(parts)


STAT_WHERE = "p.age BETWEEN 20 AND 40 AND p.sex = 'male' AND p.city IN ('NATION_10', 'NATION_2')"
STAT_WHERE_SUBSTRING = ("p.age BETWEEN 20 AND 40 AND p.sex = 'male' "
                        "AND strpos('NATION_10,NATION_2', p.city) > 0")

# Long-form categorised actions over every date.
ACTS = """acts AS (
  SELECT session_id, user_id, 'click' AS kind, click_category_id AS category_id FROM uva
  WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT session_id, user_id, 'order', TRY_CAST(order_category_ids AS BIGINT) FROM uva
  WHERE TRY_CAST(order_category_ids AS BIGINT) IS NOT NULL
  UNION ALL
  SELECT session_id, user_id, 'pay', TRY_CAST(pay_category_ids AS BIGINT) FROM uva
  WHERE TRY_CAST(pay_category_ids AS BIGINT) IS NOT NULL)"""

# Order and pay fields as the text they hold.
ACTS_TEXT = """acts AS (
  SELECT session_id, user_id, 'order' AS kind, order_category_ids AS category_id FROM uva
  UNION ALL SELECT session_id, user_id, 'pay', pay_category_ids FROM uva)"""

# Orders and payments of two categories each: the event's own and its product's number.
ACTS_SPLIT = """acts AS (
  SELECT session_id, user_id, 'order' AS kind, unnest([order_category_ids, order_product_ids]) AS category_id
  FROM uva WHERE order_category_ids IS NOT NULL)"""
ACTS_LISTS = """acts AS (
  SELECT session_id, user_id, 'order' AS kind, order_category_ids || ',' || order_product_ids AS category_id FROM uva
  UNION ALL SELECT session_id, user_id, 'pay', pay_category_ids || ',' || pay_product_ids FROM uva)"""

# Every value of a session in arrival order.
LISTS = """vals AS (
  SELECT session_id, user_id, kind, list(value ORDER BY action_time, page_id, value) AS l FROM (
    SELECT session_id, user_id, action_time, page_id, 'search' AS kind, search_keyword AS value FROM uva
    UNION ALL SELECT session_id, user_id, action_time, page_id, 'click', CAST(click_category_id AS VARCHAR) FROM uva
    UNION ALL SELECT session_id, user_id, action_time, page_id, 'order', order_category_ids FROM uva
    UNION ALL SELECT session_id, user_id, action_time, page_id, 'pay', pay_category_ids FROM uva)
  WHERE value IS NOT NULL GROUP BY session_id, user_id, kind)"""


def _list_of(kind: str) -> str:
    """A profile row's list of one kind."""
    found = f"SELECT array_to_string(l, chr(1)) FROM vals v WHERE v.session_id = p.session_id AND v.user_id = p.user_id AND kind = '{kind}'"
    return f"coalesce(({found}), '')"

ACTS_JOINED = "acts a JOIN ui u ON a.user_id = u.userid"


def _kind_count(kind: str, acts: str = ACTS) -> str:
    return (_with(_uva(dated=False), UI, acts)
            + f"SELECT a.category_id, CAST(count(*) AS BIGINT) AS {kind}_count FROM {ACTS_JOINED} "
              f"WHERE a.kind = '{kind}' AND a.category_id IS NOT NULL GROUP BY a.category_id")


def _top10_category(source: str, extra_ctes: list[str], dated: bool = False) -> str:
    return (_with(_uva(dated=dated), UI, ACTS, *extra_ctes)
            + f"""SELECT CAST({Q.TASK_ID} AS BIGINT) AS taskid, category_id AS categoryid, click_count, order_count, pay_count
FROM (SELECT a.category_id,
             CAST(count_if(a.kind = 'click') AS BIGINT) AS click_count,
             CAST(count_if(a.kind = 'order') AS BIGINT) AS order_count,
             CAST(count_if(a.kind = 'pay') AS BIGINT) AS pay_count
      FROM {source} GROUP BY a.category_id) c
WHERE click_count > 0 AND order_count > 0 AND pay_count > 0
ORDER BY click_count DESC, order_count DESC, pay_count DESC, categoryid LIMIT 10""")


SCC = f"""scc AS (
  SELECT a.session_id, a.category_id, CAST(count(*) AS BIGINT) AS click_count
  FROM {ACTS_JOINED} WHERE a.kind = 'click' GROUP BY a.session_id, a.category_id)"""

def _top(n: int) -> str:
    return f"""top AS (
  SELECT CAST({Q.TASK_ID} AS BIGINT) AS taskid, category_id AS categoryid, session_id AS sessionid, click_count,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS INTEGER) AS rank
  FROM scc QUALIFY rank <= {n})"""


TOP_SESS = _top(10)

DETAIL_COLS = f"""CAST({Q.TASK_ID} AS BIGINT) AS taskid, v.user_id AS userid, v.session_id AS sessionid, v.page_id AS pageid,
  strftime(v.action_time, '{TIME_FMT}') AS action_time, v.search_keyword,
  CAST(v.click_category_id AS VARCHAR) AS click_category_id, CAST(v.click_product_id AS VARCHAR) AS click_product_id,
  v.order_category_ids, v.order_product_ids, v.pay_category_ids, v.pay_product_ids"""

def _hours(per_day: int) -> str:
    return f"""hours AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS day, strftime(start_time, '%Y-%m-%d_%H') AS date_hour, count(*) AS hour_count
  FROM prof WHERE start_time IS NOT NULL GROUP BY 1, 2),
quotas AS (
  SELECT day, date_hour, hour_count, CAST(sum(hour_count) OVER (PARTITION BY day) AS BIGINT) AS day_count,
         CAST(hour_count * {per_day} // sum(hour_count) OVER (PARTITION BY day) AS BIGINT) AS quota
  FROM hours)"""


HOURS = _hours(Q.EXTRACT_PER_DAY)

def _drawn(seed: str) -> str:
    return f"""drawn AS (
  SELECT r.session_id, r.user_id, r.start_time, r.pick FROM (
    SELECT session_id, user_id, start_time, strftime(start_time, '%Y-%m-%d_%H') AS date_hour,
           row_number() OVER (PARTITION BY strftime(start_time, '%Y-%m-%d_%H')
                              ORDER BY md5(session_id || '|{seed}'), session_id, user_id) AS pick
    FROM prof WHERE start_time IS NOT NULL) r
  JOIN quotas q ON r.date_hour = q.date_hour WHERE r.pick <= q.quota)"""


DRAWN = _drawn(Q.EXTRACT_SEED)

EXTRACT_SELECT = f"""SELECT CAST({Q.TASK_ID} AS BIGINT) AS taskid, d.session_id AS sessionid,
       strftime(d.start_time, '{TIME_FMT}') AS start_time,
       coalesce(array_to_string(list_sort(list_distinct(list(v.search_keyword))), ','), '') AS search_keywords,
       coalesce(array_to_string(list_sort(list_distinct(list(v.click_category_id))), ','), '') AS click_category_ids
FROM drawn d JOIN uva v ON v.session_id = d.session_id AND v.user_id = d.user_id
GROUP BY d.session_id, d.user_id, d.start_time, d.pick"""


def _kv_field(record: str, name: str) -> str:
    pat = f"'^{name}=([^=]+)=*$'"
    return (f"regexp_extract(list_filter(string_split({record}, '|'), lambda x: regexp_matches(x, {pat}))[1], "
            f"{pat}, 1)")


KV_RECORDS = """kv AS (
  SELECT session_id, user_id,
         concat_ws('|', 'age=' || CAST(age AS VARCHAR), 'professional=' || professional, 'city=' || city, 'sex=' || sex) AS info
  FROM prof)"""
KV_PARAM = f"'{Q.KV_PARAM}'"


def _kv(where: str) -> str:
    return _with(*_base(), KV_RECORDS) + f"SELECT session_id, user_id, info, count(*) AS weight FROM kv WHERE {where} GROUP BY ALL"


KV_BETWEEN = (
    f"CASE WHEN {_kv_field(KV_PARAM, 'startAge')} IS NULL OR {_kv_field(KV_PARAM, 'endAge')} IS NULL THEN TRUE "
    f"ELSE coalesce(TRY_CAST({_kv_field('info', 'age')} AS INTEGER) BETWEEN "
    f"TRY_CAST({_kv_field(KV_PARAM, 'startAge')} AS INTEGER) AND TRY_CAST({_kv_field(KV_PARAM, 'endAge')} AS INTEGER), FALSE) END"
)
KV_IN = (
    f"CASE WHEN {_kv_field(KV_PARAM, 'cities')} IS NULL THEN TRUE "
    f"ELSE coalesce(list_has_any(string_split({_kv_field('info', 'city')}, ','), "
    f"string_split({_kv_field(KV_PARAM, 'cities')}, ',')), FALSE) END"
)
KV_EQUAL = (
    f"CASE WHEN {_kv_field(KV_PARAM, 'sex')} IS NULL THEN TRUE "
    f"ELSE coalesce({_kv_field('info', 'sex')} = {_kv_field(KV_PARAM, 'sex')}, FALSE) END"
)

FILTER_ALL = (
    "p.age BETWEEN 20 AND 60 AND p.professional IN ('AUTOMOBILE', 'BUILDING') AND p.sex = 'female' AND "
    f"{KEYWORD_COND} AND {CATEGORY_COND}"
)

SQL: dict[str, str] = {
    "visit_scan": _with(_uva(dated=True))
    + f"""SELECT datestr, session_id, user_id, strftime(action_time, '{TIME_FMT}') AS action_time,
       search_keyword, click_category_id, order_category_ids, pay_category_ids FROM uva""",
    "user_scan": _with(UI) + "SELECT userid, age, professional, city, sex FROM ui",
    "lenient_times": """WITH e AS (
  SELECT event_id, date_trunc('second', ts) AS plain, CASE WHEN event_id % 17 > 0 THEN date_trunc('month', ts) + to_months(event_id % 15)
    + to_days(day(ts) - 1 + event_id % 40) + to_hours(hour(ts) + event_id % 30) + to_minutes(minute(ts) + event_id % 70)
    + to_seconds(second(ts) + event_id % 100) END AS t FROM (SELECT ts, CAST(event_id AS INTEGER) AS event_id FROM events))
SELECT CAST(event_id AS BIGINT) AS event_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS time_read, coalesce(t < plain, FALSE) AS is_before,
       coalesce(t > plain, FALSE) AS is_after, CAST(coalesce(date_diff('second', plain, t), 0) AS BIGINT) AS seconds FROM e""",
    "task_params": _with(TASKS) + f"SELECT {DECODED} FROM tasks",
    "task_lookup": _with(TASKS) + f"SELECT task_name, task_type, task_status, {DECODED} FROM tasks "
    f"WHERE taskid = {Q.LOOKUP_TASK_ID}",
    "session_rollup": _with(_uva(), SESS)
    + f"SELECT session_id, user_id, strftime(start_time, '{TIME_FMT}') AS start_time, visit_length, step_length FROM sess",
    "session_profile": _with(*_base()) + PROFILE_SELECT + " GROUP BY ALL",
    "session_value_lists": _with(_uva())
    + """SELECT session_id, user_id,
       coalesce(array_to_string(list_sort(list_distinct(list(search_keyword))), ','), '') AS search_keywords,
       coalesce(array_to_string(list_sort(list_distinct(list(click_category_id))), ','), '') AS click_category_ids,
       coalesce(array_to_string(list_sort(list_distinct(list(order_category_ids))), ','), '') AS order_category_ids,
       coalesce(array_to_string(list_sort(list_distinct(list(pay_category_ids))), ','), '') AS pay_category_ids
FROM uva GROUP BY session_id, user_id""",
    "session_values": _with(_uva())
    + """SELECT session_id, user_id, kind, value, count(*) AS n FROM (
  SELECT session_id, user_id, 'search' AS kind, search_keyword AS value FROM uva
  UNION ALL SELECT session_id, user_id, 'click', CAST(click_category_id AS VARCHAR) FROM uva
  UNION ALL SELECT session_id, user_id, 'order', order_category_ids FROM uva
  UNION ALL SELECT session_id, user_id, 'pay', pay_category_ids FROM uva) WHERE value IS NOT NULL GROUP BY ALL""",
    "session_value_chunks": _with(_uva("month"), LISTS)
    + f"""SELECT session_id, user_id, kind, CAST(c AS BIGINT) AS chunk_no,
       array_to_string(l[{Q.VALUE_CHUNK} * c + 1:{Q.VALUE_CHUNK} * (c + 1)], chr(1)) AS chunk_values
FROM (SELECT *, unnest(range(0, (len(l) + {Q.VALUE_CHUNK} - 1) // {Q.VALUE_CHUNK})) AS c FROM vals)""",
    "session_profile_lists": _with(*_base(), LISTS)
    + f"""SELECT session_id, user_id, strftime(start_time, '{TIME_FMT}') AS start_time, visit_length, step_length, age, professional, city,
       sex, count(*) AS weight, CAST(0 AS BIGINT) AS chunk_no, {_list_of('search')} AS search_keywords,
       {_list_of('click')} AS click_category_ids, {_list_of('order')} AS order_category_ids, {_list_of('pay')} AS pay_category_ids
FROM prof p GROUP BY ALL""",
    "rollup_from_daily": _with(_uva("month"), SESS)
    + f"SELECT session_id, user_id, strftime(start_time, '{TIME_FMT}') AS start_time, visit_length, step_length FROM sess",
    "filter_age": _filtered("p.age BETWEEN 20 AND 40"),
    "filter_age_open": _filtered("p.age >= 50"),
    "filter_professional": _filtered(f"p.professional IN ({_in_list(Q.PROFESSIONALS)})"),
    "filter_city": _filtered("p.city IN ('NATION_10', 'NATION_2')"),
    "filter_city_substring": _filtered("strpos('NATION_10,NATION_2', p.city) > 0"),
    "filter_sex": _filtered("p.sex = 'male'"),
    "filter_keywords": _filtered(KEYWORD_COND),
    "filter_categories": _filtered(CATEGORY_COND),
    "filter_keywords_substring": _filtered(_exists_action("strpos(a.search_keyword, 'w1') > 0")),
    "filter_categories_substring": _filtered(_exists_action("strpos(CAST(a.click_category_id AS VARCHAR), '7') > 0")),
    "filter_all": _filtered(FILTER_ALL),
    "filter_keywords_long": _filtered(_exists_action("a.search_keyword IN ('kw1', 'kw8')")),
    "filter_categories_long": _filtered(_exists_action("a.click_category_id % 9 = 4")),
    "filter_keywords_ignore": _filtered("TRUE"),
    "filter_categories_ignore": _filtered("TRUE"),
    "filter_professional_substring": _filtered("strpos('AUTOMOBILE,BUILDING', p.professional) > 0"),
    "kv_between": _kv(KV_BETWEEN),
    "kv_between_no_param": _kv("TRUE"),
    "kv_in_no_field": _with(*_base())
    + """SELECT session_id, user_id, concat_ws('|', 'age=' || age, 'professional=' || professional, 'city=' || city, 'sex=' || sex) AS info,
       count(*) AS weight FROM prof WHERE city IN ('NATION_10', 'NATION_2') AND right(city, 1) NOT IN ('0', '1') GROUP BY ALL""",
    "kv_in": _kv(KV_IN),
    "kv_equal": _kv(KV_EQUAL),
    "category_click_counts": _kind_count("click"),
    "category_order_counts": _kind_count("order", ACTS_TEXT),
    "category_pay_counts": _kind_count("pay", ACTS_TEXT),
    "category_order_counts_lists": _kind_count("order", ACTS_LISTS),
    "category_pay_counts_lists": _kind_count("pay", ACTS_LISTS),
    "category_order_counts_split": _kind_count("order", ACTS_SPLIT),
    "session_category_clicks": _with(_uva(dated=False), UI, ACTS, SCC) + "SELECT session_id, category_id, click_count FROM scc",
    "visit_length_histogram": _histogram(VISIT_BUCKETS, divisor=Q.TIME_DIVISOR),
    "step_length_histogram": _histogram(STEP_BUCKETS, grain="month"),
    "session_bucket_counts": _with(*_base(dated=True), _counts_cte(STAT_WHERE)) + "SELECT * FROM cnt",
    "session_aggr_stat": _stat(STAT_WHERE),
    "session_aggr_stat_substring": _stat(STAT_WHERE_SUBSTRING),
    "session_aggr_stat_all": _stat("TRUE", divisor=Q.TIME_DIVISOR, dated=False),
    "top10_category": _top10_category(ACTS_JOINED, []),
    "top10_category_filtered": _top10_category(
        "acts a JOIN fprof f ON a.session_id = f.session_id AND a.user_id = f.user_id",
        [SESS, PROF, "fprof AS (SELECT session_id, user_id FROM prof WHERE age BETWEEN 20 AND 40 AND sex = 'male')"],
    ),
    "top10_session": _with(_uva(dated=False), UI, ACTS, SCC, TOP_SESS) + "SELECT * FROM top",
    "top_sessions_large": _with(_uva(), UI, ACTS, SCC, _top(5000)) + "SELECT * FROM top",
    "top_session_ids": _with(_uva(dated=False), UI, ACTS, SCC, TOP_SESS) + "SELECT DISTINCT sessionid AS session_id FROM top",
    "session_detail": _with(_uva(dated=False), UI, ACTS, SCC, TOP_SESS)
    + f"SELECT {DETAIL_COLS} FROM uva v WHERE v.session_id IN (SELECT sessionid FROM top)",
    "session_detail_inner": _with(_uva(dated=False), UI, ACTS, SCC, TOP_SESS)
    + f"SELECT {DETAIL_COLS}, t.categoryid FROM uva v JOIN top t ON v.session_id = t.sessionid",
    "session_detail_in_range": _with(_uva(dated=True), UI, ACTS, SCC, TOP_SESS)
    + f"SELECT {DETAIL_COLS} FROM uva v WHERE v.session_id IN (SELECT sessionid FROM top)",
    "sessions_per_hour": _with(*_base(dated=False))
    + "SELECT strftime(start_time, '%Y-%m-%d_%H') AS date_hour, count(*) AS session_count FROM prof "
      "WHERE start_time IS NOT NULL GROUP BY 1",
    "sessions_per_day": _with(*_base(dated=False))
    + "SELECT strftime(start_time, '%Y-%m-%d') AS day, count(*) AS session_count FROM prof "
      "WHERE start_time IS NOT NULL GROUP BY 1",
    "extract_quotas": _with(*_base(dated=False), HOURS) + "SELECT day, date_hour, hour_count, day_count, quota FROM quotas",
    "random_extract": _with(*_base(dated=False), HOURS, DRAWN) + EXTRACT_SELECT,
    "random_extract_large": _with(*_base(), _hours(5000), DRAWN) + EXTRACT_SELECT,
    # the task job: everything over the date range, except the detail export (all dates)
    "task_session_aggr_stat": _stat(STAT_WHERE),
    "task_top10_category": _top10_category(ACTS_JOINED, [], dated=True),
    "task_top10_session": _with(_uva(dated=True), UI, ACTS, SCC, TOP_SESS) + "SELECT * FROM top",
    "task_session_detail": _with(_uva(dated=True), UI, ACTS, SCC, TOP_SESS, _uva(dated=False, name="uva_all"))
    + f"SELECT {DETAIL_COLS} FROM uva_all v WHERE v.session_id IN (SELECT sessionid FROM top)",
    "task_random_extract": _with(*_base(dated=True), HOURS, DRAWN) + EXTRACT_SELECT,
}
# the same tables from daily states
SQL |= {f"daily_{name}": SQL[f"task_{name}"] for name in ("session_aggr_stat", "top10_category", "top10_session", "random_extract")}
