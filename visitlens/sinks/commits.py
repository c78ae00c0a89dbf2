"""A task's result tables become visible together.

Every run writes its tables to folders of its own (``<table>/taskid=<id>/run=<run>``), which
no reader looks at, and then appends one row (taskid, number, run) to the table
``task_commits``.  Readers take the run with the highest number, so they see all tables of
one run: a failure before that row leaves the old results in all tables, whatever was
written.  The row is one file of a committed Spark write, so it is there whole or not at all.

A failed run removes its folders.  A commit removes the task's folders of committed runs
before the last one; the last one stays for readers that began with it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "task_commits"
_SCHEMA = "taskid long, number long, run string"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def new_run() -> str:
    return uuid.uuid4().hex


def run_folder(base_path: str, table: str, taskid: int, run: str) -> str:
    return f"{base_path.rstrip('/')}/{table}/taskid={int(taskid)}/run={run}"


def commits(spark: SparkSession, base_path: str) -> DataFrame | None:
    """All commits (taskid, number, run); None where no run was ever committed."""
    path = f"{base_path.rstrip('/')}/{COMMITS}"
    return spark.read.schema(_SCHEMA).json(path) if exists(spark, path) else None


def current_runs(spark: SparkSession, base_path: str) -> DataFrame | None:
    """taskid, run of every task's latest commit."""
    found = commits(spark, base_path)
    return None if found is None else found.groupBy("taskid").agg(F.max_by("run", "number").alias("run"))


def current_run(spark: SparkSession, base_path: str, taskid: int) -> str | None:
    found = commits(spark, base_path)
    if found is None:
        return None
    row = found.where(F.col("taskid") == F.lit(int(taskid))).agg(F.max_by("run", "number").alias("run")).first()
    return row["run"]


def commit(spark: SparkSession, base_path: str, taskid: int, run: str, tables: list[str]) -> None:
    """Make ``run`` the task's results and remove folders no reader needs any more."""
    before = commits(spark, base_path)
    old = []
    if before is not None:
        mine = before.where(F.col("taskid") == F.lit(int(taskid))).orderBy(F.desc("number"))
        old = [(r["number"], r["run"]) for r in mine.collect()]  # one row a run of this task
    number = max(time.time_ns(), old[0][0] + 1 if old else 0)
    row = spark.createDataFrame([(int(taskid), number, run)], _SCHEMA).coalesce(1)
    row.write.mode("append").json(f"{base_path.rstrip('/')}/{COMMITS}")
    for _, superseded in old[1:]:
        discard(spark, base_path, taskid, superseded, tables)


def discard(spark: SparkSession, base_path: str, taskid: int, run: str, tables: list[str]) -> None:
    """Remove a run's folders."""
    for table in tables:
        fs, found = _path(spark, run_folder(base_path, table, taskid, run))
        if fs.exists(found):
            fs.delete(found, True)
