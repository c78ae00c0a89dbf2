"""Semi joins beyond the broadcast limit, and long parameter lists."""

from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from visitlens.operators import joins, predicates, sessions, topn
from visitlens.params import TaskParams
from visitlens.plans import queries as Q
from visitlens.sources import fixtures


def _shuffled_rows(df):
    """Rows that ran into each shuffle of the executed plan."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if "QueryStage" in name:
            return visit(node.plan())
        if name == "Exchange":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return found


def test_bitmap_keeps_every_id_and_few_others(spark):
    ids = spark.range(0, 200_000, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    every = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "k string, id long"))
    near = joins.probably_in(every, ids, "k", 1 << 20)
    assert near.columns == every.columns
    rows = [r.id for r in near.select("id").collect()]
    assert len(rows) == len(set(rows)) and set(range(0, 200_000, 4)) <= set(rows) and -1 not in rows
    others = len(rows) - 50_000
    assert others < 0.08 * 150_000
    small = joins.probably_in(every, ids, "k", 32 << 10)  # a smaller bitmap lets more pass, never less
    assert set(range(0, 200_000, 4)) <= {r.id for r in small.select("id").collect()}
    assert joins.probably_in(every, ids, "k", 4096) is every  # too small to be of use
    assert joins.probably_in(every, ids, "k", -1) is every


def test_detail_beyond_the_broadcast_limit_shuffles_little(spark):
    visits, top = fixtures.visit_actions(spark, SF_MID), Q.top10_session(spark, SF_MID).where("categoryid < 3").persist()
    try:
        expected = sorted(map(str, topn.session_detail(visits, top, 1, measure=False).collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # so the joins themselves shuffle
        whole = max(_shuffled_rows(topn.session_detail(visits, top, 1, measure=False)))
        ids = topn.top_session_ids(top)
        near = joins.probably_in(visits, ids, "session_id", 1 << 20)
        probed = near.join(ids, "session_id", "left_semi").select(*topn._detail_columns(1))
        assert sorted(map(str, probed.collect())) == expected
        assert whole == visits.count() and sorted(_shuffled_rows(probed))[-1] < 0.2 * whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        top.unpersist()


def test_session_detail_takes_the_bitmap_beyond_the_limit(spark):
    visits, top = fixtures.visit_actions(spark, SF_SMALL), Q.top10_session(spark, SF_SMALL)
    expected = sorted(map(str, topn.session_detail(visits, top, 1, measure=False).collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
        detail = topn.session_detail(visits, top, 1)
        plan = detail._jdf.queryExecution().optimizedPlan().toString()
        assert "bit_or" in plan and "LeftSemi" in plan
        assert sorted(map(str, detail.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_long_lists_are_no_literals(spark):
    visits = fixtures.visit_actions(spark, SF_SMALL)
    for params, short in (
        (TaskParams(keywords=Q.LONG_KEYWORDS), TaskParams(keywords="kw1,kw8")),
        (TaskParams(category_ids=Q.LONG_CATEGORY_IDS + ",x,--4"), TaskParams(category_ids="4,13,22,31,40,49,58,67,76,85,94")),
    ):
        for make in (sessions.session_rollup, sessions.rollup_and_kinds):
            long = make(visits, params)
            plan = long._jdf.queryExecution().optimizedPlan().toString()
            assert "kw701" not in plan and "INSET" not in plan and "Join LeftOuter" in plan and len(plan) < 20_000
            assert sorted(map(str, long.collect())) == sorted(map(str, make(visits, short).collect()))


def test_only_long_any_lists_are_joined(spark):
    visits = fixtures.visit_actions(spark, SF_SMALL)
    few = TaskParams(keywords=",".join(f"kw{i}" for i in range(predicates.LONG_LIST)))
    assert predicates.mark_listed(visits, few) is visits
    assert predicates.mark_listed(visits, TaskParams(keywords=Q.LONG_KEYWORDS, keyword_mode="ignore")) is visits
