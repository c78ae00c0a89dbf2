"""Command line: ``python -m visitlens.plans TASKID --tasks PATH --visits PATH --users PATH --out PATH``.

Runs one task on an existing (cluster) session; the task id comes first,
as in the reference's job arguments.  With ``--tables`` the visit log and the
users are names of catalog (Hive) tables instead of paths.  Every option of
``TaskParams`` has a flag.
"""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from visitlens.params import JSON_KEYS, TaskParams
from visitlens.plans.job import run_task
from visitlens.session import apply_job_conf
from visitlens.sources.tasks import load_params, read_tasks, task_id_from_args
from visitlens.sources.users import read_hive_users, read_user_info
from visitlens.sources.visits import read_hive_visits, read_visit_table, read_visit_text


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="visitlens.plans")
    ap.add_argument("taskid")
    ap.add_argument("--tasks", required=True, help="task table (parquet)")
    ap.add_argument("--visits", required=True, help="visit log: parquet table or text with --text")
    form = ap.add_mutually_exclusive_group()
    form.add_argument("--text", action="store_true", help="visit log is \\001-separated text")
    form.add_argument("--tables", action="store_true", help="visit log and users are catalog (Hive) table names")
    ap.add_argument("--users", required=True, help="user_info table (parquet)")
    ap.add_argument("--out", required=True, help="base folder of the result tables")
    ap.add_argument("--checkpoint", action="store_true", help="cut lineage into spark.checkpoint.dir")
    ap.add_argument("--scale", action="store_true", help="apply the large-input sizing where the cluster sets none")
    options = [f for f in fields(TaskParams) if f.name not in JSON_KEYS.values()]
    for f in options:
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            ap.add_argument(flag, action="store_true", default=None)
        else:
            ap.add_argument(flag, type=type(f.default), help=f"default: {f.default}")
    args = ap.parse_args(argv)
    taskid = task_id_from_args([args.taskid])
    if taskid is None:
        raise SystemExit("taskid must be an integer")
    builder = SparkSession.builder.appName("visitlens-task")
    spark = (builder.enableHiveSupport() if args.tables and SparkSession.getActiveSession() is None else builder).getOrCreate()
    apply_job_conf(spark, scale=args.scale)
    chosen = {f.name: getattr(args, f.name) for f in options if getattr(args, f.name) is not None}
    params = load_params(read_tasks(spark, args.tasks), taskid, **chosen)
    if args.tables:
        visits, users = read_hive_visits(spark, args.visits), read_hive_users(spark, args.users)
    else:
        visits = read_visit_text(spark, args.visits) if args.text else read_visit_table(spark, args.visits)
        users = read_user_info(spark, args.users)
    for table, path in run_task(spark, visits, users, params, taskid, args.out, args.checkpoint).items():
        print(f"{table}\t{path}")


if __name__ == "__main__":
    main()
