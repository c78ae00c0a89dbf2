"""Sources (text visit log, task table, JSON params), sinks, the task job, streaming ingest."""

import json
import os

import pytest

from conftest import SF_SMALL
from visitlens.params import TaskParams
from visitlens.plans.job import run_task
from visitlens.schema import RESULT_TABLES, VISIT_ACTION
from visitlens.sinks import read_result
from visitlens.sources import decode_params, fixtures, load_params, read_tasks, read_visit_text
from visitlens.sources.tasks import task_id_from_args
from visitlens.streaming import start_ingest, visit_text_stream

SEP = "\u0001"
TEXT_LINES = [
    SEP.join(["2019-01-01", "7", "abc", "3", "2019-01-01 5:03:04", "kw1", "null", "null", "null", "null", "null", "null"]),
    SEP.join(["2019-01-01", "7", "abc", "4", "2019-01-01 5:03:09", "null", "12", "40", "null", "null", "null", "null"]),
    SEP.join(["2019-01-01", "8", "def", "1", "2019-01-01 17:00:00", "null", "null", "null", "3", "9", "null", "null"]),
]


def _write_text(folder, name="part-0.txt"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(TEXT_LINES) + "\n")


def test_read_visit_text(spark, tmp_path):
    _write_text(str(tmp_path / "t"))
    df = read_visit_text(spark, str(tmp_path / "t"))
    assert df.schema == VISIT_ACTION
    rows = {(r.session_id, r.page_id): r for r in df.collect()}
    first = rows[("abc", 3)]
    assert str(first.action_time) == "2019-01-01 05:03:04"  # unpadded hour parsed
    assert first.search_keyword == "kw1" and first.click_category_id is None  # "null" text -> NULL
    assert rows[("abc", 4)].click_category_id == 12 and rows[("def", 1)].order_category_ids == "3"


def test_task_params_from_json():
    p = TaskParams.from_json('{"startDate":"2024-01-05","startAge":20,"cities":["A","B"],"sex":null}')
    assert p.start_date == "2024-01-05" and p.start_age == "20"
    assert p.cities == '["A","B"]'  # arrays stay JSON text, as the reference reads them
    assert p.sex is None and p.end_date is None
    with pytest.raises(ValueError):
        TaskParams(list_match="fuzzy")


def test_task_table_lookup(spark, tmp_path):
    param = '{"startDate":"2024-01-01","endDate":"2024-01-31","sex":"male","cities":["NATION_1"]}'
    rows = [(1, "t1", None, None, None, "session", "new", param), (2, "t2", None, None, None, "session", "new", "{}")]
    df = spark.createDataFrame(rows, "taskid long, task_name string, create_time string, start_time string, "
                                     "finish_time string, task_type string, task_status string, task_param string")
    df.write.parquet(str(tmp_path / "task"))
    tasks = read_tasks(spark, str(tmp_path / "task"))
    p = load_params(tasks, 1, top_scope="filtered")
    assert p.sex == "male" and p.top_scope == "filtered" and p.end_date == "2024-01-31"
    decoded = {r.taskid: r for r in decode_params(tasks).collect()}
    assert decoded[1].cities == '["NATION_1"]' and decoded[2].sex is None
    with pytest.raises(KeyError):
        load_params(tasks, 99)
    assert task_id_from_args(["5"]) == 5 and task_id_from_args([]) is None and task_id_from_args(["x"]) is None


def test_run_task_writes_idempotently(spark, tmp_path):
    visits = fixtures.visit_actions(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    params = TaskParams(start_date="2024-01-01", end_date="2024-01-31", sex="male", extract_per_day=20)
    out = str(tmp_path / "out")
    paths = run_task(spark, visits, users, params, 11, out)
    assert set(paths) == set(RESULT_TABLES)
    counts = {t: read_result(spark, out, t, 11).count() for t in paths}
    assert counts["session_aggr_stat"] == 1 and counts["top10_category"] == 10
    assert counts["top10_session"] > 0 and counts["session_detail"] > 0 and counts["session_random_extract"] > 0
    run_task(spark, visits, users, params, 11, out)  # re-run replaces, does not append
    run_task(spark, visits, users, params.with_options(sex="female"), 12, out)
    again = {t: read_result(spark, out, t, 11).count() for t in paths}
    assert again == counts
    for t, schema in RESULT_TABLES.items():
        got = read_result(spark, out, t)
        assert sorted(got.columns) == sorted(f.name for f in schema.fields)


def test_run_task_refuses_empty_selection(spark, tmp_path):
    visits = fixtures.visit_actions(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    params = TaskParams(start_age="200")
    with pytest.raises(ValueError):
        run_task(spark, visits, users, params, 3, str(tmp_path / "out"))
    assert not os.path.exists(str(tmp_path / "out"))


def test_streaming_ingest(spark, tmp_path):
    src = str(tmp_path / "incoming")
    _write_text(src)
    q = start_ingest(visit_text_stream(spark, src), str(tmp_path / "table"), str(tmp_path / "ckpt"),
                     available_now=True)
    q.awaitTermination(120)
    _write_text(src, "part-1.txt")
    q = start_ingest(visit_text_stream(spark, src), str(tmp_path / "table"), str(tmp_path / "ckpt"),
                     available_now=True)
    q.awaitTermination(120)
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 6  # second run picks up only the new file
    assert table.where("datestr = '2019-01-01'").count() == 6


def test_params_roundtrip():
    p = TaskParams(start_date="2024-01-01", cities="A,B")
    assert json.loads(p.to_json()) == {"startDate": "2024-01-01", "cities": "A,B"}
    assert TaskParams.from_json(p.to_json()) == p


def test_partitioned_table_prunes_dates(spark, tmp_path):
    from visitlens.operators.predicates import date_range
    from visitlens.sources import read_visit_table

    path = str(tmp_path / "uva")
    fixtures.visit_actions(spark, SF_SMALL).write.partitionBy("datestr").parquet(path)
    visits = date_range(read_visit_table(spark, path), "2024-01-05", "2024-01-07")
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datestr" in plan and "2024-01-05" in plan
    direct = fixtures.visit_actions(spark, SF_SMALL, start_date="2024-01-05", end_date="2024-01-07")
    assert visits.count() == direct.count() > 0


def test_restrict_dates_D7_and_checkpoint(spark, tmp_path):
    from visitlens.plans.job import build_task

    visits = fixtures.visit_actions(spark, SF_SMALL, grain="month")  # sessions span the month
    users = fixtures.user_info(spark, SF_SMALL)
    base = TaskParams(start_date="2024-01-10", end_date="2024-01-12", extract_per_day=0)
    if spark.sparkContext.getCheckpointDir() is None:  # tests only: the session names none
        spark.sparkContext.setCheckpointDir(str(tmp_path / "ckpt"))
    for restrict in (False, True):
        res, kept = build_task(visits, users, base.with_options(restrict_dates=restrict), 5, checkpoint=True)
        try:
            days = {r.action_time[:10] for r in res.session_detail.collect()}
            in_range = {"2024-01-10", "2024-01-11", "2024-01-12"}
            if restrict:
                assert days and days <= in_range
            else:  # as the reference: every action of a top session, any date
                assert days - in_range
            assert res.session_random_extract is None
        finally:
            for df in kept:
                df.unpersist()


def test_table_readers_and_cli(spark, tmp_path):
    from visitlens.plans.__main__ import main
    from visitlens.sources.users import read_hive_users
    from visitlens.sources.visits import read_hive_visits

    visits = fixtures.visit_actions(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    visits.createOrReplaceTempView("user_visit_action")
    users.createOrReplaceTempView("user_info_view")
    assert read_hive_visits(spark).count() == visits.count()
    assert read_hive_users(spark, "user_info_view").count() == users.count()
    vpath, upath, tpath = str(tmp_path / "v"), str(tmp_path / "u"), str(tmp_path / "t")
    visits.write.partitionBy("datestr").parquet(vpath)
    users.write.parquet(upath)
    spark.createDataFrame(
        [(9, "t", None, None, None, "session", "new", '{"startDate":"2024-01-01","endDate":"2024-01-31"}')],
        "taskid long, task_name string, create_time string, start_time string, finish_time string, "
        "task_type string, task_status string, task_param string",
    ).write.parquet(tpath)
    out = str(tmp_path / "out")
    main(["9", "--tasks", tpath, "--visits", vpath, "--users", upath, "--out", out])
    stat = read_result(spark, out, "session_aggr_stat", 9).first()
    assert stat.session_count > 0
    # catalog tables and the options of TaskParams
    out2 = str(tmp_path / "out2")
    main(["9", "--tasks", tpath, "--visits", "user_visit_action", "--users", "user_info_view", "--out", out2, "--tables",
          "--keyword-mode", "ignore", "--top-n", "2", "--extract-per-day", "0", "--restrict-dates"])
    assert read_result(spark, out2, "session_aggr_stat", 9).first().session_count == stat.session_count
    assert read_result(spark, out2, "top10_category", 9).count() == 2
    assert read_result(spark, out2, "session_random_extract", 9).count() == 0


def test_write_result_replaces_only_its_task(spark, tmp_path):
    from visitlens.sinks import write_result

    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # the writer must not rely on it
    try:
        rows = lambda t, n: spark.createDataFrame(
            [(t, c, 1, 1, 1) for c in range(n)], "taskid long, categoryid long, click_count long, "
            "order_count long, pay_count long")
        out = str(tmp_path / "res")
        write_result(rows(1, 3), out, "top10_category", 1)
        write_result(rows(2, 4), out, "top10_category", 2)
        write_result(rows(1, 2), out, "top10_category", 1)  # re-run of task 1
        counts = {r.taskid: r["count"] for r in read_result(spark, out, "top10_category").groupBy("taskid").count().collect()}
        assert counts == {1: 2, 2: 4}
        write_result(rows(1, 2).limit(0), out, "top10_category", 1)  # a re-run without rows
        counts = {r.taskid: r["count"] for r in read_result(spark, out, "top10_category").groupBy("taskid").count().collect()}
        assert counts == {2: 4}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_text_and_parquet_paths_agree(spark, tmp_path):
    """The generator's text format through the whole job equals the parquet path."""
    from pyspark.sql import functions as F

    from visitlens.functions.dates import format_date
    from visitlens.plans.__main__ import main

    visits = fixtures.visit_actions(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    t = F.col("action_time")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    as_text = {"action_time": F.concat(format_date(t), F.lit(" "), F.hour(t).cast("string"), F.lit(":"),
                                       two(F.minute(t)), F.lit(":"), two(F.second(t)))}
    fields = [F.coalesce(as_text.get(c, F.col(c)).cast("string"), F.lit("null")) for c in visits.columns]
    text_dir, pq_dir = str(tmp_path / "text"), str(tmp_path / "pq")
    visits.select(F.concat_ws(SEP, *fields).alias("value")).write.text(text_dir)
    visits.write.parquet(pq_dir)
    users.write.parquet(str(tmp_path / "u"))
    param = '{"startDate":"2024-01-03","endDate":"2024-01-28","startAge":"20","endAge":"50"}'
    spark.createDataFrame(
        [(1, "t", None, None, None, "s", "new", param), (2, "t", None, None, None, "s", "new", param)],
        "taskid long, task_name string, create_time string, start_time string, finish_time string, "
        "task_type string, task_status string, task_param string",
    ).write.parquet(str(tmp_path / "t"))
    out = str(tmp_path / "out")
    common = ["--tasks", str(tmp_path / "t"), "--users", str(tmp_path / "u"), "--out", out]
    main(["1", "--visits", text_dir, "--text", *common])
    main(["2", "--visits", pq_dir, *common])
    for table in RESULT_TABLES:
        a = read_result(spark, out, table, 1).drop("taskid")
        b = read_result(spark, out, table, 2).drop("taskid")
        assert a.count() == b.count() > 0, table
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table


def test_scale_conf_only_fills_unset_keys(spark):
    from visitlens.session import SCALE_CONF, apply_job_conf

    keys = list(SCALE_CONF) + ["spark.sql.shuffle.partitions"]
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        apply_job_conf(spark, scale=True)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("512m", str(512 << 20) + "b")
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("256m", str(256 << 20) + "b")
        assert spark.conf.get("spark.sql.shuffle.partitions") == saved["spark.sql.shuffle.partitions"]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sql_views_match_dataframe_rollup(spark):
    from visitlens.operators.sessions import session_rollup

    fixtures.register_views(spark, SF_SMALL)
    sql = spark.sql(
        "SELECT session_id, user_id, count(session_id) AS step_length FROM user_visit_action "
        "WHERE datestr BETWEEN '2024-01-05' AND '2024-01-25' GROUP BY session_id, user_id"
    )
    dated = fixtures.visit_actions(spark, SF_SMALL).where("datestr BETWEEN '2024-01-05' AND '2024-01-25'")
    df = session_rollup(dated).select("session_id", "user_id", "step_length")
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0
    assert spark.sql("SELECT count(*) AS n FROM user_info").first().n == fixtures.user_info(spark, SF_SMALL).count()


def test_streaming_default_checkpoint_under_session_folder(spark, tmp_path):
    from visitlens.session import checkpoint_dir

    base = checkpoint_dir(spark, fallback=str(tmp_path / "ckpt"))  # tests only: set where unset
    src = str(tmp_path / "incoming")
    _write_text(src)
    name = f"ingest_{os.getpid()}_{abs(hash(str(tmp_path))) % 10**6}"
    q = start_ingest(visit_text_stream(spark, src), str(tmp_path / "table"), available_now=True, name=name)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3
    local = base.replace("file:", "")
    assert [d for d in os.listdir(os.path.join(local, "streams")) if d.startswith(name)]
    # the same source feeds a second table under the same query name
    q = start_ingest(visit_text_stream(spark, src), str(tmp_path / "second"), available_now=True, name=name)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "second")).count() == 3


def test_text_keeps_quotes_and_fractions(spark, tmp_path):
    line = ["2019-01-01", "7", "abc", "3", "2019-01-01 5:03:09.0", '"hot pot', "12", "40", "3,5", '"', "null", "null"]
    os.makedirs(tmp_path / "q")
    (tmp_path / "q" / "part.txt").write_text(SEP.join(line) + "\n")
    r = read_visit_text(spark, str(tmp_path / "q")).first()
    assert (r.search_keyword, r.click_category_id, r.order_category_ids, r.order_product_ids) == ('"hot pot', 12, "3,5", '"')
    assert str(r.action_time) == "2019-01-01 05:03:09"
    q = start_ingest(visit_text_stream(spark, str(tmp_path / "q")), str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "t")).first().search_keyword == '"hot pot'


def test_category_ids_that_are_no_numbers(spark):
    from visitlens.operators.predicates import category_action_test

    df = spark.createDataFrame([(5,), (-5,), (7,)], "click_category_id long")
    test = category_action_test(TaskParams(category_ids="--5,-5,x,7"))
    assert sorted(r[0] for r in df.where(test).collect()) == [-5, 7]


def test_rerun_leaves_no_old_rows(spark, tmp_path):
    visits, users, out = fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), str(tmp_path / "o")
    wide = TaskParams(start_date="2024-01-01", end_date="2024-01-31", extract_per_day=20)
    run_task(spark, visits, users, wide, 3, out)
    run_task(spark, visits, users, wide, 4, out)
    run_task(spark, visits.where("click_category_id IS NULL"), users, wide.with_options(extract_per_day=0), 3, out)
    for table in ("top10_category", "top10_session", "session_detail", "session_random_extract"):
        assert read_result(spark, out, table, 3).count() == 0
        assert read_result(spark, out, table, 4).count() > 0
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_repeated_task_id_is_refused(spark, tmp_path):
    row = (1, "t", None, None, None, "session", "new", "{}")
    df = spark.createDataFrame([row, row], "taskid long, task_name string, create_time string, start_time string, "
                                           "finish_time string, task_type string, task_status string, task_param string")
    with pytest.raises(ValueError):
        load_params(df, 1)
