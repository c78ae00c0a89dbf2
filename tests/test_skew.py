"""Hot keys and copies: one session holds a third of all actions, one userid is
listed many times.  Results must equal a brute-force evaluation of the
reference semantics (plain joins, every copy multiplied out) in pandas."""

import hashlib
import random
from collections import Counter
from datetime import datetime, timedelta

import pandas as pd
import pytest

from visitlens.operators import extract, predicates, sessions, stats, topn
from visitlens.params import TaskParams
from visitlens.schema import STEP_BUCKETS, USER_INFO, VISIT_ACTION, VISIT_BUCKETS

N_ROWS = 3000
COPIES = 40  # userid 0 is listed this many times (identical rows) + 1 variant


def _data():
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(N_ROWS):
        if i % 3 == 0:  # the hot session: a third of all rows
            sid, uid = "hot", 0
            t = base + timedelta(hours=9, seconds=i)
        else:
            uid = rnd.randint(0, 30)
            day = rnd.randint(0, 3)
            sid = f"{uid}_{day}"
            t = base + timedelta(days=day, hours=rnd.randint(0, 23), seconds=rnd.randint(0, 3000))
        kind = rnd.choice(["kw", "click", "order", "pay"])
        cat = rnd.randint(0, 6)
        rows.append((
            t.strftime("%Y-%m-%d"), uid, sid, i % 10, t,
            f"kw{cat}" if kind == "kw" else None,
            cat if kind == "click" else None, 1 if kind == "click" else None,
            str(cat) if kind == "order" else None, "1" if kind == "order" else None,
            str(cat) if kind == "pay" else None, "1" if kind == "pay" else None,
        ))
    users = [(0, 30, "ENGINEER", "NATION_1", "male")] * COPIES + [(0, 52, "ENGINEER", "NATION_1", "male")]
    users += [(u, 20 + u, "ARTIST" if u % 2 else "DOCTOR", f"NATION_{u % 3}", "female" if u % 2 else "male")
              for u in range(1, 31)]
    return rows, users


@pytest.fixture(scope="module")
def data(spark):
    rows, users = _data()
    v = spark.createDataFrame(rows, VISIT_ACTION)
    u = spark.createDataFrame(users, USER_INFO)
    vp = pd.DataFrame(rows, columns=[f.name for f in VISIT_ACTION.fields])
    up = pd.DataFrame(users, columns=[f.name for f in USER_INFO.fields])
    return v, u, vp, up


def _brute_profile(vp, up):
    g = vp.groupby(["session_id", "user_id"])
    s = pd.DataFrame({
        "start": g["action_time"].min(),
        "end": g["action_time"].max(),
        "steps": g.size(),
    }).reset_index()
    s["visit"] = (s["end"].dt.floor("s") - s["start"].dt.floor("s")).dt.total_seconds().astype(int)
    return s.merge(up, left_on="user_id", right_on="userid")  # copies multiply, as the reference


def test_stats_match_brute_force(data):
    v, u, vp, up = data
    params = TaskParams(end_age="40", sex="male")
    prof = sessions.session_profile(sessions.session_rollup(v, params), u)
    got = stats.bucket_counts(predicates.filter_sessions(prof, params)).first().asDict()
    bp = _brute_profile(vp, up)
    bp = bp[(bp.age <= 40) & (bp.sex == "male")]
    assert got["session_count"] == len(bp)
    for name, lo, hi in VISIT_BUCKETS:
        m = (bp.visit >= lo) & ((bp.visit <= hi) if hi is not None else True)
        assert got[f"visit_length_{name}"] == int(m.sum()), name
    for name, lo, hi in STEP_BUCKETS:
        m = (bp.steps >= lo) & ((bp.steps <= hi) if hi is not None else True)
        assert got[f"step_length_{name}"] == int(m.sum()), name
    assert got["session_count"] > COPIES  # the hot session's 40 copies are in


def _brute_actions(vp):
    out = []
    for r in vp.itertuples():
        if r.click_category_id is not None and not pd.isna(r.click_category_id):
            out.append((r.session_id, r.user_id, "click", int(r.click_category_id)))
        if r.order_category_ids is not None:
            out.append((r.session_id, r.user_id, "order", int(r.order_category_ids)))
        if r.pay_category_ids is not None:
            out.append((r.session_id, r.user_id, "pay", int(r.pay_category_ids)))
    return pd.DataFrame(out, columns=["session_id", "user_id", "kind", "category_id"])


def test_top_n_match_brute_force(data):
    v, u, vp, up = data
    acts = topn.category_actions(v)
    w = topn.user_weights(u)
    joined = _brute_actions(vp).merge(up[["userid"]], left_on="user_id", right_on="userid")
    expect = Counter((r.category_id, r.kind) for r in joined.itertuples())
    got = {r.category_id: r for r in topn.category_counts(acts, w).collect()}
    for cat, r in got.items():
        assert (r.click_count, r.order_count, r.pay_count) == (
            expect[(cat, "click")], expect[(cat, "order")], expect[(cat, "pay")])
    clicks = joined[joined.kind == "click"].groupby(["session_id", "category_id"]).size()
    top = topn.top_sessions_per_category(topn.session_category_clicks(acts, w), 10).collect()
    for r in top:
        assert clicks[(r.sessionid, r.categoryid)] == r.click_count
    hot = [r for r in top if r.sessionid == "hot"]
    assert hot and all(r.rank == 1 for r in hot)


def test_filtered_scope_weights(data):
    v, u, vp, up = data
    params = TaskParams(start_age="50", top_scope="filtered")
    prof = sessions.session_profile(sessions.session_rollup(v, params), u)
    w = topn.session_weights(predicates.filter_sessions(prof, params))
    got = {r.category_id: r.click_count for r in topn.kind_counts(topn.category_actions(v), w, "click").collect()}
    bp = _brute_profile(vp, up)
    keep = bp[bp.age >= 50][["session_id", "user_id"]]
    joined = _brute_actions(vp).merge(keep, on=["session_id", "user_id"])
    expect = joined[joined.kind == "click"].groupby("category_id").size().to_dict()
    assert got == expect and expect  # only the one user-0 variant aged 52 qualifies


def test_extract_matches_brute_force(data):
    v, u, vp, up = data
    per_day, seed = 7, "s"
    prof = sessions.session_profile(sessions.session_rollup(v), u)
    got = Counter(
        (r.sessionid, r.start_time, r.search_keywords, r.click_category_ids)
        for r in extract.random_extract(prof, v, per_day, seed).collect()
    )
    bp = _brute_profile(vp, up)
    bp["date_hour"] = bp.start.dt.strftime("%Y-%m-%d_%H")
    bp["day"] = bp.start.dt.strftime("%Y-%m-%d")
    bp["draw"] = [hashlib.md5(f"{s}|{seed}".encode()).hexdigest() for s in bp.session_id]
    hours = bp.groupby(["day", "date_hour"]).size().rename("hc").reset_index()
    hours["dc"] = hours.groupby("day")["hc"].transform("sum")
    hours["quota"] = hours.hc * per_day // hours.dc
    expect = Counter()
    for _, h in hours.iterrows():
        part = bp[bp.date_hour == h.date_hour].sort_values(
            ["draw", "session_id", "user_id", "age", "professional", "city", "sex"])
        for r in part.head(int(h.quota)).itertuples():
            acts = vp[(vp.session_id == r.session_id) & (vp.user_id == r.user_id)]
            kws = ",".join(sorted({k for k in acts.search_keyword if k is not None}))
            cats = ",".join(str(c) for c in sorted({int(c) for c in acts.click_category_id.dropna()}))
            expect[(r.session_id, r.start.strftime("%Y-%m-%d %H:%M:%S"), kws, cats)] += 1
    assert got == expect
    assert got[next(k for k in got if k[0] == "hot")] >= 1


def test_users_are_folded_before_the_join(data):
    v, u, _, _ = data
    prof = sessions.session_profile(sessions.session_rollup(v), u)
    hot = prof.where("session_id = 'hot'").collect()
    assert sorted((r.age, r.weight) for r in hot) == [(30, COPIES), (52, 1)]


def test_job_path_counts_match_brute_force(data):
    v, u, vp, up = data
    kinds = topn.session_category_kinds(topn.category_actions(v))
    w = topn.user_weights(u)
    joined = _brute_actions(vp).merge(up[["userid"]], left_on="user_id", right_on="userid")
    expect = Counter((r.category_id, r.kind) for r in joined.itertuples())
    for r in topn.category_counts_from(kinds, w).collect():
        assert (r.click_count, r.order_count, r.pay_count) == (
            expect[(r.category_id, "click")], expect[(r.category_id, "order")], expect[(r.category_id, "pay")])
    clicks = joined[joined.kind == "click"].groupby(["session_id", "category_id"]).size().to_dict()
    got = {(r.session_id, r.category_id): r.click_count for r in topn.session_clicks_from(kinds, w).collect()}
    assert got == clicks


@pytest.mark.parametrize("split", [False, True])
def test_rollup_and_kinds_equal_the_separate_operators(data, split):
    v, u, vp, up = data
    params = TaskParams(keywords="kw1,kw3", category_ids="2,5")
    combined = sessions.rollup_and_kinds(v, params, split)
    a = sessions.rollup_part(combined)
    b = sessions.session_rollup(v, params)
    assert sorted(a.columns) == sorted(b.columns)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0
    k1 = sessions.kinds_part(combined)
    k2 = topn.session_category_kinds(topn.category_actions(v, split))
    assert k1.exceptAll(k2.select(*k1.columns)).count() == 0 and k2.select(*k1.columns).exceptAll(k1).count() == 0


def test_narrow_aggregate_equals_the_wide_one(data):
    v, u, vp, up = data
    params = TaskParams(keywords="kw1,kw3", category_ids="2,5")
    wide, narrow = sessions.rollup_and_kinds(v, params), sessions.rollup_and_kinds(v, params, keywords=False)
    assert "keyword" not in narrow.columns
    for part in (sessions.rollup_part, sessions.kinds_part):
        a, b = part(wide), part(narrow)
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # times and flags stand in the session's own row only
    assert narrow.where("category_id IS NOT NULL AND (start_time IS NOT NULL OR step_length > 0 OR keyword_hit)").count() == 0
    assert narrow.count() < wide.count()


def test_extract_from_parts_equals_extract_from_visits(data):
    v, u, vp, up = data
    prof = sessions.session_profile(sessions.session_rollup(v), u)
    combined = sessions.rollup_and_kinds(v)
    a = extract.random_extract_from_parts(prof, sessions.kinds_part(combined), sessions.keywords_part(combined), 7, "s")
    b = extract.random_extract(prof, v, 7, "s")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def split_joins(spark):
    """Broadcasts off and skew thresholds small enough for test data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def many_visits(spark, hot_session: bool):
    """Half of the sessions belong to user 1; with ``hot_session`` they are one session."""
    hot = "id % 2 = 0"
    return spark.range(0, 60_000, numPartitions=6).selectExpr(
        "'2024-01-01' AS datestr",
        f"CASE WHEN {hot} THEN 1 ELSE id % 997 + 2 END AS user_id",
        f"CASE WHEN {hot} AND {str(hot_session).lower()} THEN 's' ELSE concat('s', id) END AS session_id",
        "id AS page_id",
        "make_timestamp_ntz(2024, 1, 1, 1, 1, 1) AS action_time",
        "cast(null AS string) AS search_keyword",
        "id % 3 AS click_category_id",
        "id AS click_product_id",
        "cast(null AS string) AS order_category_ids", "cast(null AS string) AS order_product_ids",
        "cast(null AS string) AS pay_category_ids", "cast(null AS string) AS pay_product_ids",
    )


def test_hot_user_is_split(split_joins):
    users = split_joins.range(1, 1000).selectExpr(
        "id AS userid", "20 AS age", "'p' AS professional", "'c' AS city", "'male' AS sex")
    visits = many_visits(split_joins, hot_session=False)
    clicks = topn.session_category_clicks(topn.category_actions(visits, kind="click"), topn.user_weights(users))
    assert "skew=true" in final_plan(clicks)


def test_hot_session_is_split(split_joins):
    visits = many_visits(split_joins, hot_session=True)
    top = split_joins.createDataFrame([("s", 1)] + [(f"s{i}", 1) for i in range(1, 4000, 2)], "sessionid string, categoryid long")
    detail = topn.session_detail(visits, top, 1, measure=False)
    assert "skew=true" in final_plan(detail)
    assert detail.count() == 30_000 + 2000
