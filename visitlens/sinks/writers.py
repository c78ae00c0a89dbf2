"""Result sinks.

A task's results go to its own ``taskid=<id>`` folder of each table, so re-running a task
replaces its rows, with fewer or none too, instead of appending a second copy (the
reference appends).  ``write_result`` replaces one table's folder; with a ``run`` it writes
beside the old results, and ``sinks.commits`` makes all tables of a run visible together.
Each executor writes its own files; nothing passes through the driver.  A JDBC writer is
provided for relational targets: Spark batches inserts per partition (``batchsize``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.schema import RESULT_TABLES
from visitlens.sinks.commits import current_run, current_runs, exists, run_folder


def conform_result(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of a result table, in table order."""
    schema = RESULT_TABLES[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_result(
    df: DataFrame, base_path: str, table: str, taskid: int, fmt: str = "parquet", run: str | None = None
) -> str:
    """Write ``df`` as ``<base_path>/<table>/taskid=<id>/``, replacing that task's rows.

    The task's folder itself is overwritten, so an empty result replaces the
    old rows too; other tasks' folders are never touched.  With ``run`` the rows go to
    that run's folder and are read once the run is committed.
    """
    path = f"{base_path.rstrip('/')}/{table}"
    folder = f"{path}/taskid={int(taskid)}" if run is None else run_folder(base_path, table, taskid, run)
    conform_result(df, table).drop("taskid").write.mode("overwrite").format(fmt).save(folder)
    return path


def clear_result(
    spark: SparkSession, base_path: str, table: str, taskid: int, fmt: str = "parquet", run: str | None = None
) -> str:
    """Leave no rows of the task in a result table."""
    return write_result(spark.createDataFrame([], RESULT_TABLES[table]), base_path, table, taskid, fmt, run)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    batchsize: int = 1000,
    mode: str = "append",
) -> None:
    """Insert a result table into a database, one batched insert stream per partition."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    conform_result(df, table).write.jdbc(url, table, mode=mode, properties=props)


def read_result(spark, base_path: str, table: str, taskid: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Rows of a result table, of one task or all: those of the committed runs, or, where
    runs are not used, whatever the task folders hold."""
    path = f"{base_path.rstrip('/')}/{table}"
    if taskid is not None:
        run = current_run(spark, base_path, taskid)
        if run is not None:
            folder = run_folder(base_path, table, taskid, run)
            if not exists(spark, folder):  # this run did not write the table
                return spark.createDataFrame([], RESULT_TABLES[table])
            df = spark.read.format(fmt).load(folder)
            return df.select(F.lit(int(taskid)).cast("bigint").alias("taskid"), *df.columns)
        df = spark.read.format(fmt).load(path)
        return df.where(F.col("taskid") == F.lit(int(taskid)))
    df, runs = spark.read.format(fmt).load(path), current_runs(spark, base_path)
    if runs is None or "run" not in df.columns:
        return df
    return df.join(runs, ["taskid", "run"], "left_semi").drop("run")
