"""Incremental ingestion of the visit-log text format into the columnar table.

The analysis itself is batch-only (as in the reference).  What arrives
continuously is the generator's output: ``\\001``-separated text files.  A
Structured Streaming file source picks new files up, conforms them to the
VISIT_ACTION schema and appends them to a parquet table partitioned by
``datestr`` (so the batch job's date range becomes partition pruning).
Progress lives in a checkpoint folder on shared storage, so a restarted or
failed query resumes without duplicating files (file sink is exactly-once).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from visitlens.schema import VISIT_ACTION_TEXT
from visitlens.session import checkpoint_dir
from visitlens.sources.visits import FIELD_SEP, NULL_TEXT, checked_visits, conform


def visit_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over text files appearing under ``path``."""
    reader = (
        spark.readStream.schema(VISIT_ACTION_TEXT)
        .option("sep", FIELD_SEP)
        .option("nullValue", NULL_TEXT)
        .option("quote", "")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return conform(reader.csv(path))


def checked_text_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, strict_values: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(visits, rejects)``, two streams over the same files (``sources.visits.checked_visits``)."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return checked_visits(reader.text(path), strict_values=strict_values)


def _checkpoint(stream: DataFrame, table_path: str, name: str) -> str:
    table = hashlib.sha256(table_path.rstrip("/").encode()).hexdigest()[:16]
    return f"{checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{name}-{table}"


def start_reject_log(
    rejects: DataFrame,
    table_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str = "1 minute",
    name: str = "visit_log_rejects",
) -> StreamingQuery:
    """Append rejected lines to a table of their own, partitioned by ``reason``."""
    writer = (
        rejects.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint_location or _checkpoint(rejects, table_path, name))
        .partitionBy("reason")
        .outputMode("append")
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def start_ingest(
    stream: DataFrame,
    table_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str = "1 minute",
    name: str = "visit_log_ingest",
) -> StreamingQuery:
    """Append the stream to a ``datestr``-partitioned parquet table.

    Progress is kept in ``checkpoint_location``; by default a sub-folder of the
    session's ``spark.checkpoint.dir`` (the cluster's shared folder), never a
    machine-local one; without either the call fails.  The default folder is
    named after the query and the table, so the same source can feed several
    tables.
    """
    if checkpoint_location is None:
        checkpoint_location = _checkpoint(stream, table_path, name)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("datestr")
        .outputMode("append")
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
