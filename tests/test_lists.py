"""Ordered session lists in chunks, and buckets at sampled splitters, against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import visit_row
from pyspark.sql import functions as F

from visitlens.operators import lists, ranking, sessions, topn

SEP = lists.SEPARATOR


def _rows(n=4000, hot=0.6):
    rnd = random.Random(9)
    base, rows = datetime(2024, 1, 1), []
    for i in range(n):
        sid = "hot" if rnd.random() < hot else f"s{rnd.randint(0, 40)}"
        t = base + timedelta(seconds=rnd.randint(0, 300 if sid == "hot" else 90_000))
        kind, value = rnd.choice(["kw", "click", "order", "pay", "none"]), rnd.randint(0, 9)
        rows.append(visit_row(sid, len(sid) % 3, t, page=rnd.randint(0, 3), **({} if kind == "none" else
                    {kind: value if kind == "click" else f"v{value}" if kind == "kw" else str(value)})))
    return rows + [visit_row(None, 1, base, kw="nobody"), visit_row(None, 1, base, kw="nobody"), visit_row("nulls", None, base, order="3,5")]


def _expected(rows):
    out = defaultdict(list)
    for r in rows:
        for kind, value in (("search", r[5]), ("click", None if r[6] is None else str(r[6])), ("order", r[8]), ("pay", r[10])):
            if value is not None:
                out[r[2], r[1], kind].append((r[4], r[3], value))
    return {k: [v for *_, v in sorted(vs)] for k, vs in out.items()}


@pytest.mark.parametrize("chunk, split_rows", [(7, 50), (10_000, 10_000)])
def test_chunks_are_the_lists(monkeypatch, make_visits, chunk, split_rows):
    monkeypatch.setattr(lists, "split_large_groups", lambda df, g, k: ranking.split_large_groups(df, g, k, rows=split_rows))
    rows = _rows()
    got = lists.session_value_chunks(make_visits(rows), chunk).collect()
    expected = _expected(rows)
    by_list = defaultdict(dict)
    for r in got:
        assert r.chunk_no not in by_list[r.session_id, r.user_id, r.kind]
        by_list[r.session_id, r.user_id, r.kind][r.chunk_no] = r["values"]
    assert set(by_list) == set(expected)
    for key, chunks in by_list.items():
        assert sorted(chunks) == list(range(len(chunks)))
        assert all(len(chunks[i]) == chunk for i in range(len(chunks) - 1)) and 0 < len(chunks[len(chunks) - 1]) <= chunk
        assert [v for i in sorted(chunks) for v in chunks[i]] == expected[key]


def test_a_hot_session_is_split(spark, make_visits):
    """60 % of the rows are one session: no bucket (window group) holds more than a few of them."""
    base = datetime(2024, 1, 1)
    rnd = random.Random(1)
    rows = [visit_row("hot" if i % 5 < 3 else f"s{i}", 1, base + timedelta(seconds=rnd.randint(0, 100_000)), kw=f"k{i % 11}") for i in range(20_000)]
    values = lists._values(make_visits(rows), False)
    parts = ranking.split_large_groups(values, lists._LIST, lists._ORDER, rows=1000)
    sizes = [r["count"] for r in parts.where("session_id = 'hot'").groupBy("_bucket").count().collect()]
    mean = sum(sizes) / ranking.SPLITS
    assert len(sizes) > 200 and max(sizes) <= 2 * mean
    plan = lists.session_value_chunks(make_visits(rows))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line or "- Window" in line]
    assert windows and all("_bucket" in line or "kind" in line for line in windows)


def test_equal_actions_are_folded(make_visits):
    t = datetime(2024, 1, 1)
    rows = [visit_row("s", 1, t, kw="a")] * 25 + [visit_row("s", 1, t, kw="b")] * 3
    got = {r.chunk_no: r["values"] for r in lists.session_value_chunks(make_visits(rows), 10).collect()}
    assert got == {0: ["a"] * 10, 1: ["a"] * 10, 2: ["a"] * 5 + ["b"] * 3}


def test_profile_with_lists(make_visits, make_users):
    rows = _rows(600, 0.3)
    visits, users = make_visits(rows), make_users([(u, 20 + u, "P", "C", "male") for u in (0, 1, 2)])
    visits = visits.unionByName(make_visits([visit_row("empty", 1, datetime(2024, 1, 2))]))
    profile = sessions.session_profile(sessions.session_rollup(visits), users)
    wide = lists.session_profile_lists(profile, visits)
    got = {(r.session_id, r.user_id): r for r in wide.collect()}
    expected = _expected(rows)
    assert len(got) == wide.count() == profile.count()
    for (sid, uid), r in got.items():
        for kind, name in lists.KIND_COLUMNS.items():
            assert r[name] == SEP.join(expected.get((sid, uid, kind), []))
        assert r.chunk_no == 0
    assert got["empty", 1].search_keywords == ""


def test_profile_lists_continue_in_further_rows(make_visits, make_users):
    rows = [visit_row("s", 1, datetime(2024, 1, 1) + timedelta(seconds=i), kw=f"k{i}") for i in range(25)]
    rows += [visit_row("s", 1, datetime(2024, 1, 1), click=5)]
    visits = make_visits(rows)
    profile = sessions.session_profile(sessions.session_rollup(visits), make_users([(1, 30, "P", "C", "male")]))
    got = sorted(lists.session_profile_lists(profile, visits, chunk=10).collect(), key=lambda r: r.chunk_no)
    assert [r.chunk_no for r in got] == [0, 1, 2]
    assert SEP.join(r.search_keywords for r in got) == SEP.join(f"k{i}" for i in range(25))
    assert [r.click_category_ids for r in got] == ["5", "", ""]


def test_top_sessions_of_ids_that_begin_alike(spark, make_users):
    """30,000 sessions tie at one click and share their first 20 characters."""
    n = 30_000
    clicks = spark.range(n).select(
        F.concat(F.lit("a-common-beginning--"), F.sha2(F.col("id").cast("string"), 256)).alias("session_id"),
        F.lit(7).cast("bigint").alias("category_id"), F.when(F.col("id") < 3, 2).otherwise(1).cast("bigint").alias("click_count"))
    tied = clicks.withColumn("_clicks", -F.col("click_count"))
    cut = ranking.split_large_groups(tied, ["category_id", "_clicks"], ["session_id"])
    sizes = [r["count"] for r in cut.where("_clicks = -1").groupBy("_bucket").count().collect()]
    assert len(sizes) == ranking.SPLITS and max(sizes) <= 2 * n / ranking.SPLITS
    order = sorted((-r.click_count, r.session_id) for r in clicks.collect())
    for top in (10, 5000):
        got = topn.top_sessions_per_category(clicks, top).collect()
        assert sorted((r["rank"], r.sessionid) for r in got) == [(i + 1, s) for i, (_, s) in enumerate(order[:top])]


def test_comma_ids_count_as_the_reference_counts_them(make_visits, make_users):
    t = datetime(2024, 1, 1)
    rows = [visit_row("s", 1, t, order="3,5"), visit_row("s", 1, t, order="3,5"), visit_row("s", 1, t, order="3"),
            visit_row("s", 1, t, order="null"), visit_row("s", 1, t, order=""), visit_row("s", 1, t, pay="x"), visit_row("s", 1, t, click=3)]
    visits, weights = make_visits(rows), topn.user_weights(make_users([(1, 30, "P", "C", "male")]))
    count = lambda kind, split=False: {r[0]: r[1] for r in topn.kind_counts(topn.category_actions(visits, split, kind), weights, kind).collect()}
    assert count("order") == {"3,5": 2, "3": 1}
    assert count("pay") == {"x": 1}
    assert count("order", True) == {"3": 3, "5": 2}
    assert count("click") == {3: 1}


def test_split_points_follow_any_key(spark):
    df = spark.createDataFrame([(None, i % 97, f"{i:05d}") for i in range(3000)], "g string, a int, b string")
    cut = ranking.split_large_groups(df, ["g"], ["a", "b"], rows=100)
    rows = sorted((r.a, r.b, r._bucket) for r in cut.collect())
    assert len(rows) == 3000 and [r[2] for r in rows] == sorted(r[2] for r in rows)
    assert max(Counter(r[2] for r in rows).values()) <= 2 * 3000 / ranking.SPLITS
