"""Task table: look a task up by key and decode its JSON parameters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.params import JSON_KEYS, TaskParams
from visitlens.schema import TASK

TASK_COLUMNS = [f.name for f in TASK.fields]


def read_tasks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TASK.fields])


def read_tasks_jdbc(spark: SparkSession, url: str, table: str = "task", properties: dict | None = None) -> DataFrame:
    """Tasks from a relational database (needs the JDBC driver on the classpath)."""
    return spark.read.jdbc(url, table, properties=properties or {})


def task_by_id(tasks: DataFrame, taskid: int) -> DataFrame:
    return tasks.where(F.col("taskid") == F.lit(int(taskid)).cast("bigint"))


def decode_params(tasks: DataFrame, *kept: str) -> DataFrame:
    """``taskid``, the ``kept`` columns and one text column per JSON key
    (``get_json_object``: arrays stay JSON text)."""
    cols = [F.get_json_object("task_param", f"$.{key}").alias(attr) for key, attr in JSON_KEYS.items()]
    return tasks.select("taskid", *kept, *cols)


def load_params(tasks: DataFrame, taskid: int, **options: Any) -> TaskParams:
    """Parameters of one task as a driver-side object; its key must be unique."""
    row = task_by_id(tasks, taskid).select("task_param").limit(2).collect()
    if not row:
        raise KeyError(f"no task with taskid={taskid}")
    if len(row) > 1:
        raise ValueError(f"several tasks with taskid={taskid}")
    return TaskParams.from_json(row[0]["task_param"], **options)


def task_id_from_args(args: list[str]) -> int | None:
    """First command-line argument as a task id; None when absent or bad."""
    try:
        return int(args[0]) if args else None
    except ValueError:
        return None
