"""Daily session states: merged results equal those from the actions."""

import random
from datetime import datetime, timedelta

from conftest import SF_SMALL, visit_row

from visitlens.operators import daily, sessions, topn
from visitlens.params import TaskParams
from visitlens.plans.job import build_task, run_task
from visitlens.schema import RESULT_TABLES
from visitlens.sinks import read_result
from visitlens.sources import fixtures

PARAMS = TaskParams(start_date="2024-01-03", end_date="2024-01-20", start_age="20", end_age="55", extract_per_day=30)


def _rows(n=1500):
    """Sessions that go on over midnight; values that repeat on several days."""
    rnd = random.Random(4)
    rows = []
    for _ in range(n):
        t = datetime(2024, 1, 1, 22) + timedelta(seconds=rnd.randint(0, 4 * 86_400))
        kind, value = rnd.choice(["kw", "click", "order", "pay", "none"]), rnd.randint(0, 5)
        rows.append(visit_row(f"s{rnd.randint(0, 30)}", rnd.randint(0, 2), t, **({} if kind == "none" else
                    {kind: value if kind == "click" else f"k{value}" if kind == "kw" else rnd.choice([str(value), "3,5", "null"])})))
    return rows


def _set(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_merged_states_equal_the_actions(spark, make_visits, tmp_path):
    visits = make_visits(_rows())
    path = str(tmp_path / "states")
    daily.write_daily_states(visits, path)
    states = daily.read_daily_states(spark, path)
    for params in (None, TaskParams(keywords="k1,k3", category_ids="2,4"), TaskParams(keywords="k", keyword_mode="substring")):
        a = daily.rollup_from_daily(*states, params)
        b = sessions.session_rollup(visits, params)
        assert _set(a.select(b.columns)) == _set(b)
    for split in (False, True):
        kinds = topn.session_category_kinds(topn.category_actions(visits, split))
        assert _set(daily.kinds_from_daily(states.values, split).select(kinds.columns)) == _set(kinds)
    words = visits.where("search_keyword IS NOT NULL").selectExpr("session_id", "user_id", "search_keyword AS keyword").distinct()
    assert _set(daily.keywords_from_daily(states.values)) == _set(words)


def test_a_day_written_again_replaces_itself_only(spark, make_visits, tmp_path):
    rows, path = _rows(400), str(tmp_path / "states")
    visits = make_visits(rows)
    days = sorted({r[0] for r in rows})
    for day in days:
        daily.write_daily_states(visits.where(visits.datestr == day), path)
    daily.write_daily_states(visits.where(visits.datestr == days[1]).limit(0), path)  # no day, nothing replaced
    assert _set(daily.rollup_from_daily(daily.read_daily_states(spark, path).sessions)) == _set(sessions.session_rollup(visits))
    fewer = make_visits([r for r in rows if r[0] != days[1]] + [r for r in rows if r[0] == days[1]][:5])
    daily.write_daily_states(fewer.where(fewer.datestr == days[1]), path)
    assert _set(daily.rollup_from_daily(daily.read_daily_states(spark, path).sessions)) == _set(sessions.session_rollup(fewer))


def test_a_task_reads_states(spark, tmp_path):
    visits, users = fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL)
    path = str(tmp_path / "states")
    daily.write_daily_states(visits, path)
    states = daily.read_daily_states(spark, path)
    run_task(spark, visits, users, PARAMS, 1, str(tmp_path / "a"))
    run_task(spark, visits, users, PARAMS, 1, str(tmp_path / "b"), states=states)
    for table in RESULT_TABLES:
        a, b = (read_result(spark, str(tmp_path / d), table, 1) for d in "ab")
        assert _set(a) == _set(b) and a.count()
    results, _ = build_task(visits, users, PARAMS, 1, reuse=False, states=states)
    for name in ("session_aggr_stat", "top10_category", "top10_session", "session_random_extract"):
        plan = getattr(results, name)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan and "PartitionFilters: [isnotnull(datestr" in plan
    assert "events.parquet" in results.session_detail._jdf.queryExecution().executedPlan().toString()
