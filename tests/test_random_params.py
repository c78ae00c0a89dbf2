"""Random task parameters: Spark's filtered bucket counts equal DuckDB SQL built
from the same parameters (seeded, sf0.001)."""

import random

import duckdb
import pytest

from conftest import SF_SMALL
from visitlens.functions.buckets import in_bucket_sql
from visitlens.params import TaskParams, tokens
from visitlens.plans import oracle as O
from visitlens.plans import queries as Q
from visitlens.schema import STEP_BUCKETS, VISIT_BUCKETS

CITIES = [f"NATION_{i}" for i in range(25)]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _random_params(rnd: random.Random) -> TaskParams:
    kw = {}
    if rnd.random() < 0.6:
        lo = rnd.randint(18, 50)
        kw["start_age"], kw["end_age"] = rnd.choice([(str(lo), str(lo + rnd.randint(0, 20))), (str(lo), None),
                                                     (None, str(lo))])
    if rnd.random() < 0.5:
        kw["cities"] = ",".join(rnd.sample(CITIES, rnd.randint(1, 4)))
        kw["list_match"] = rnd.choice(["token", "substring"])
    if rnd.random() < 0.4:
        kw["professionals"] = ",".join(rnd.sample(SEGMENTS, rnd.randint(1, 3)))
    if rnd.random() < 0.4:
        kw["sex"] = rnd.choice(["male", "female"])
    if rnd.random() < 0.4:
        kw["keywords"] = ",".join(f"kw{i}" for i in rnd.sample(range(10), rnd.randint(1, 3)))
        kw["keyword_mode"] = rnd.choice(["any", "substring"])
    if rnd.random() < 0.4:
        kw["category_ids"] = ",".join(str(i) for i in rnd.sample(range(100), rnd.randint(1, 5)))
        kw["category_mode"] = rnd.choice(["any", "substring"])
    return TaskParams(**kw)


def _sql_where(p: TaskParams) -> str:
    conds = ["TRUE"]
    lo, hi = p.age_bounds()
    if lo is not None or hi is not None:
        conds.append("p.age IS NOT NULL")
        if lo is not None:
            conds.append(f"p.age >= {lo}")
        if hi is not None:
            conds.append(f"p.age <= {hi}")
    for col, raw in (("city", p.cities), ("professional", p.professionals)):
        if raw:
            if p.list_match == "substring":
                conds.append(f"strpos('{raw}', p.{col}) > 0")
            else:
                conds.append(f"p.{col} IN ({', '.join(repr(t) for t in tokens(raw))})")
    if p.sex:
        conds.append(f"p.sex = '{p.sex}'")
    if p.keywords:
        words = tokens(p.keywords)
        test = (" OR ".join(f"strpos(a.search_keyword, '{w}') > 0" for w in words) if p.keyword_mode == "substring"
                else f"a.search_keyword IN ({', '.join(repr(w) for w in words)})")
        conds.append(O._exists_action(f"({test})"))
    if p.category_ids:
        ids = tokens(p.category_ids)
        test = (" OR ".join(f"strpos(CAST(a.click_category_id AS VARCHAR), '{i}') > 0" for i in ids)
                if p.category_mode == "substring" else f"a.click_category_id IN ({', '.join(ids)})")
        conds.append(O._exists_action(f"({test})"))
    return " AND ".join(conds)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("seed", range(10))
def test_random_params_match_sql(spark, duck, seed):
    p = _random_params(random.Random(seed))
    from visitlens.operators import predicates, stats

    prof = Q._profile(spark, SF_SMALL, p, dated=False)
    got = stats.bucket_counts(predicates.filter_sessions(prof, p)).first().asDict()
    cols = ["count(*)"] + [f"coalesce(count_if({in_bucket_sql('visit_length', lo, hi)}), 0)" for _, lo, hi in VISIT_BUCKETS]
    cols += [f"coalesce(count_if({in_bucket_sql('step_length', lo, hi)}), 0)" for _, lo, hi in STEP_BUCKETS]
    sql = O._with(*O._base(dated=False)) + f"SELECT {', '.join(cols)} FROM prof p WHERE {_sql_where(p)}"
    expect = duck.execute(sql).fetchone()
    names = ["session_count"] + [f"visit_length_{n}" for n, _, _ in VISIT_BUCKETS]
    names += [f"step_length_{n}" for n, _, _ in STEP_BUCKETS]
    assert [got[n] for n in names] == list(expect), (p, sql)


@pytest.mark.parametrize("seed", range(4))
def test_task_top_n_random_dates_match_sql(spark, duck, seed):
    from visitlens.plans.job import build_task
    from visitlens.sources import fixtures

    rnd = random.Random(100 + seed)
    a, b = sorted(rnd.sample(range(1, 31), 2))
    start, end = f"2024-01-{a:02d}", f"2024-01-{b:02d}"
    params = TaskParams(start_date=start, end_date=end, extract_per_day=0)
    res, kept = build_task(fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), params, 1)
    try:
        got_cat = sorted(tuple(r) for r in res.top10_category.collect())
        got_sess = sorted(tuple(r)[:4] for r in res.top10_session.collect())
    finally:
        for df in kept:
            df.unpersist()
    uva = O._uva(start=start, end=end)
    cat_sql = O._with(uva, O.UI, O.ACTS) + f"""
        SELECT 1 AS taskid, category_id, click_count, order_count, pay_count FROM (
          SELECT a.category_id, count_if(a.kind = 'click') AS click_count, count_if(a.kind = 'order') AS order_count,
                 count_if(a.kind = 'pay') AS pay_count
          FROM {O.ACTS_JOINED} GROUP BY a.category_id)
        WHERE click_count > 0 AND order_count > 0 AND pay_count > 0
        ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"""
    sess_sql = O._with(uva, O.UI, O.ACTS, O.SCC, O.TOP_SESS) + "SELECT taskid, categoryid, sessionid, click_count FROM top"
    assert got_cat == sorted(duck.execute(cat_sql).fetchall())
    assert got_sess == sorted(duck.execute(sess_sql).fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_task_extract_random_draws_match_sql(spark, duck, seed):
    from visitlens.plans.job import build_task
    from visitlens.sources import fixtures

    rnd = random.Random(200 + seed)
    a, b = sorted(rnd.sample(range(1, 31), 2))
    start, end = f"2024-01-{a:02d}", f"2024-01-{b:02d}"
    per_day, draw_seed = rnd.randint(1, 40), f"s{rnd.randint(0, 999)}"
    params = TaskParams(start_date=start, end_date=end, extract_per_day=per_day, extract_seed=draw_seed)
    res, kept = build_task(fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), params, 1)
    try:
        got = sorted(tuple(r) for r in res.session_random_extract.collect())
    finally:
        for df in kept:
            df.unpersist()
    uva = O._uva(start=start, end=end)
    sql = O._with(uva, O.UI, O.SESS, O.PROF, O._hours(per_day), O._drawn(draw_seed)) + O.EXTRACT_SELECT
    expect = sorted(duck.execute(sql).fetchall())
    assert got == expect and got


def test_task_filtered_scope_equals_registered_query(spark):
    from visitlens.plans.job import build_task
    from visitlens.sources import fixtures

    params = TaskParams(start_age="20", end_age="40", sex="male", top_scope="filtered", extract_per_day=0)
    res, kept = build_task(fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), params, 1)
    try:
        got = sorted(tuple(r) for r in res.top10_category.collect())
    finally:
        for df in kept:
            df.unpersist()
    expect = sorted(tuple(r) for r in Q.QUERIES["top10_category_filtered"](spark, SF_SMALL).collect())
    assert got == expect and got


@pytest.mark.parametrize("seed", range(4))
def test_task_stat_random_params_match_sql(spark, duck, seed):
    from visitlens.plans.job import build_task
    from visitlens.sources import fixtures

    p = _random_params(random.Random(300 + seed)).with_options(
        start_date=Q.RANGE[0], end_date=Q.RANGE[1], extract_per_day=0)
    res, kept = build_task(fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), p, 1)
    try:
        got = tuple(res.session_aggr_stat.first())
    finally:
        for df in kept:
            df.unpersist()
    expect = duck.execute(O._stat(_sql_where(p))).fetchone()
    assert got == tuple(expect), p
