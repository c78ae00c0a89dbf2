"""A task's tables are published together, and failures leave the old ones."""

import os

import pytest
from conftest import SF_SMALL

from visitlens.params import TaskParams
from visitlens.plans import job
from visitlens.schema import RESULT_TABLES
from visitlens.sinks import commits, read_result, writers
from visitlens.sources import fixtures

WIDE = TaskParams(start_date="2024-01-01", end_date="2024-01-31", extract_per_day=20)


def _tables(spark, out, taskid):
    return {t: sorted(tuple(str(v) for v in r) for r in read_result(spark, out, t, taskid).collect()) for t in RESULT_TABLES}


def _inputs(spark):
    return fixtures.visit_actions(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL)


@pytest.mark.parametrize("failing", ["top10_session", "session_random_extract"])
def test_a_failure_leaves_all_old_tables(spark, tmp_path, monkeypatch, failing):
    visits, users = _inputs(spark)
    out = str(tmp_path / "o")
    job.run_task(spark, visits, users, WIDE, 3, out)
    old = _tables(spark, out, 3)
    assert all(old.values())

    def breaks(df, base, table, *args, **more):
        if table == failing:
            raise OSError("disk full")
        return writers.write_result(df, base, table, *args, **more)

    monkeypatch.setattr(job, "write_result", breaks)
    narrow = WIDE.with_options(sex="female", start_date="2024-01-10")
    with pytest.raises(OSError):
        job.run_task(spark, visits, users, narrow, 3, out)
    assert _tables(spark, out, 3) == old
    assert commits.commits(spark, out).count() == 1
    folders = [f for t in RESULT_TABLES for f in os.listdir(os.path.join(out, t, "taskid=3")) if f.startswith("run=")]
    assert len(set(folders)) == 1 and len(folders) == len(RESULT_TABLES)  # the failed run left nothing
    monkeypatch.undo()
    job.run_task(spark, visits, users, narrow, 3, out)
    assert _tables(spark, out, 3) != old


def test_a_failed_commit_leaves_all_old_tables(spark, tmp_path, monkeypatch):
    visits, users = _inputs(spark)
    out = str(tmp_path / "o")
    job.run_task(spark, visits, users, WIDE, 3, out)
    old = _tables(spark, out, 3)

    def breaks(*args):
        raise OSError("no commit")

    monkeypatch.setattr(job, "commit", breaks)
    with pytest.raises(OSError):
        job.run_task(spark, visits, users, WIDE.with_options(sex="male"), 3, out)
    assert _tables(spark, out, 3) == old


def test_readers_follow_the_last_commit(spark, tmp_path):
    out = str(tmp_path / "o")
    schema = RESULT_TABLES["top10_category"]
    rows = lambda task, n: spark.createDataFrame([(task, i, 9 - i, 1, 1) for i in range(n)], schema)
    for task, run, n in ((1, "a", 3), (2, "b", 4), (1, "c", 1), (1, "d", 2), (3, "e", 0)):
        writers.write_result(rows(task, n), out, "top10_category", task, run=run)
        commits.commit(spark, out, task, run, ["top10_category"])
    writers.write_result(rows(1, 8), out, "top10_category", 1, run="uncommitted")
    assert {t: read_result(spark, out, "top10_category", t).count() for t in (1, 2, 3)} == {1: 2, 2: 4, 3: 0}
    every = read_result(spark, out, "top10_category")
    assert {r.taskid: r["count"] for r in every.groupBy("taskid").count().collect()} == {1: 2, 2: 4}
    assert sorted(every.columns) == sorted(f.name for f in schema.fields)
    left = sorted(os.listdir(os.path.join(out, "top10_category", "taskid=1")))
    assert [f for f in left if f.startswith("run=")] == ["run=c", "run=d", "run=uncommitted"]  # the run before stays for its readers
    assert read_result(spark, out, "top10_category", 1).schema["taskid"].dataType.simpleString() == "bigint"
    assert commits.current_run(spark, out, 99) is None


def test_tables_without_runs_are_read_as_before(spark, tmp_path):
    out = str(tmp_path / "o")
    schema = RESULT_TABLES["top10_category"]
    writers.write_result(spark.createDataFrame([(5, 1, 1, 1, 1)], schema), out, "top10_category", 5)
    assert read_result(spark, out, "top10_category", 5).count() == read_result(spark, out, "top10_category").count() == 1
